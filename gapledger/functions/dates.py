"""Dates held as text, day and week counts, display forms, plan years."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DISPLAY_FORMAT = "dd-MMM, yyyy"
_DATE_TIME = r"^(\d{1,2})-(\d{1,2})-(\d{4}) (\d{1,2}:\d{1,2}:\d{1,2})\z"
_DATE_FIRST = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"


def text_date(text: Column) -> Column:
    """Date out of the first ten characters, whatever follows them; null unless they are
    a whole ``yyyy-MM-dd``. The text of an earlier date thus sorts before a later one's."""
    return F.when(text.rlike(_DATE_FIRST), F.left(text, F.lit(10)).try_cast("date"))


def days_since(day: Column, as_of: dt.date) -> Column:
    return F.datediff(F.lit(as_of), day)


def week_boundaries(day: Column, as_of: dt.date, week_start: str = "monday") -> Column:
    """Week starts passed between two days; Friday to Monday counts one."""
    if week_start not in ("monday", "sunday"):
        raise ValueError(f"week_start must be monday or sunday, not {week_start!r}")
    shift = 1 if week_start == "sunday" else 0
    later = as_of + dt.timedelta(days=shift)
    later_week = later - dt.timedelta(days=later.weekday())
    earlier_week = F.trunc(F.date_add(day, shift) if shift else day, "week")
    return (F.datediff(F.lit(later_week), earlier_week) / 7).cast("int")


def business_days_since(day: Column, as_of: dt.date, week_start: str = "monday") -> Column:
    """Days less two per week boundary. Public holidays are not known."""
    return days_since(day, as_of) - week_boundaries(day, as_of, week_start) * 2


def needed_by_utc(text: Column) -> Column:
    """``MM-dd-yyyy HH:mm:ss`` in UTC, leading zeros optional, as a zone-less timestamp;
    anything else gives null."""
    # A text that fits always comes out changed, its year being moved to the front.
    rearranged = F.regexp_replace(text, _DATE_TIME, "$3-$1-$2 $4")
    return F.nullif(rearranged, text).try_cast("timestamp_ntz")


def local_date(utc: Column, zone: str) -> Column:
    """Calendar date in ``zone`` of a zone-less UTC timestamp, whatever the
    session time zone is."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc))


def display_date(day: Column) -> Column:
    return F.date_format(day, DISPLAY_FORMAT)


def parse_display_date(text: Column) -> Column:
    return F.to_date(text, DISPLAY_FORMAT)


def past_due(need_by: Column, as_of_time: dt.datetime) -> Column:
    """Whether the report time lies after the start of the need-by day."""
    return F.lit(as_of_time.isoformat(sep=" ")).cast("timestamp_ntz") > need_by.cast("timestamp_ntz")


def data_cut_label(as_of_time: dt.datetime) -> Column:
    """When the data was cut, e.g. ``Data cut on 2001-06-20 at 09 AM``."""
    cut = F.lit(as_of_time.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.date_format(cut, "'Data cut on' yyyy-MM-dd 'at' hh a")


def with_plan_years(df: DataFrame, text: str, as_of: dt.date, years: str) -> DataFrame:
    """Add the plan years a text column names, from two years back to four ahead.

    Three spellings are tried in turn and the first that finds anything wins:
    the year between blanks, before a blank, before an underscore.
    """
    window = range(as_of.year - 2, as_of.year + 5)

    def listed(spelling: str) -> Column:
        return F.concat_ws(", ", *[
            F.when(F.contains(F.col(text), F.lit(spelling.format(year))), str(year)) for year in window
        ])

    spaced, spaced_after = F.col("_spaced"), F.col("_spaced_after")
    return (
        df.withColumn("_spaced", listed(" {} "))
        .withColumn("_spaced_after", F.when(spaced == "", listed("{} ")))
        .withColumn(years, F.when(spaced != "", spaced).when(spaced_after != "", spaced_after).otherwise(listed("{}_")))
        .drop("_spaced", "_spaced_after")
    )
