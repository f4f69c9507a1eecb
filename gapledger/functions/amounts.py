"""Money amounts in free text, in millions, rounded to one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A decimal number, optionally with single underscores between digits and an
# exponent; surrounding white space is allowed.
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
_NUMBER = rf"(?U)^\s*([+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?)\s*$"

# Either a comma followed by one or two numeric characters only, or a comma and
# further on a last one with no numeric character after it.
_POINT_COMMA = r",(?:([^,0-9.]*(?:[0-9.][^,0-9.]*){1,2})|([^,]*),([^,0-9.]*))$"
_TRAILING_COMMA = r",([^,0-9.]*)$"


def _without(text: Column, characters: str) -> Column:
    for character in characters:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def _names_thousands(text: Column) -> Column:
    return F.contains(text, F.lit("K")) | F.contains(text, F.lit("k"))


def parse_number(text: Column) -> Column:
    """Number as double; anything that is not wholly a number gives null. The empty text,
    which titles without a dollar sign come down to, skips the pattern."""
    return F.when(text != "", _without(F.regexp_extract(text, _NUMBER, 1), "_").try_cast("double"))


def round_one(value: Column) -> Column:
    """One decimal place, ties to even on the exact binary value.

    ``round`` and ``bround`` work on the shortest decimal text instead, so
    0.25 and 0.35 come out differently there. An infinite value gives null.
    """
    return F.call_function("format_number", value, F.lit("0.0")).try_cast("double")


def amount_tail(title: Column) -> Column:
    """The text from the first non-blank after the first dollar sign, or ''."""
    after = F.ltrim(F.substr(title, F.instr(title, F.lit("$")) + 1))
    return F.when(F.contains(title, F.lit("$")), after).otherwise("")


def repair_commas(token: Column) -> Column:
    """Commas that cannot be thousands separators.

    One with one or two numeric characters after it is a decimal point (``1,5``
    reads 1.5). One with none is dropped, and the comma before it becomes the
    decimal point (``1,234,`` reads 1.234).
    """
    repaired = F.regexp_replace(F.regexp_replace(token, _POINT_COMMA, ".$1$2$3"), _TRAILING_COMMA, "$1")
    return F.when(F.contains(token, F.lit(",")), repaired).otherwise(token)


def with_amount(df: DataFrame, text: str, amount: str) -> DataFrame:
    """Add the requested amount in millions, read from a title column.

    A unit inside the amount's own token decides. Without one, the number is
    read as plain currency, and a unit anywhere later in the title rescales it.
    Each step is a column of its own, so that nothing is computed twice.
    """
    tail, token, number, plain = (F.col(c) for c in ("_tail", "_token", "_number", "_plain"))
    in_millions, in_thousands = F.contains(token, F.lit("M")), _names_thousands(token)
    digits = (
        F.when(in_millions, _without(token, "M"))
        .when(in_thousands, F.translate(token, "Kk", ""))
        .otherwise(_without(token, ","))
    )
    rescaled = (
        F.when(F.contains(tail, F.lit("M")), plain * 1000000)
        .when(_names_thousands(tail), plain * 1000)
        .otherwise(plain)
    )
    scaled = (
        F.when(in_millions, number)
        .when(in_thousands, number / 1000)
        .when(plain < 10000, rescaled)
        .otherwise(plain)
    )
    return (
        df.withColumn("_tail", amount_tail(F.col(text)))
        .withColumn("_raw_token", _without(F.substring_index(tail, " ", 1), ")$"))
        .withColumn("_token", repair_commas(F.col("_raw_token")))
        .withColumn("_number", parse_number(digits))
        .withColumn("_plain", number / 1000000)
        .withColumn(amount, round_one(scaled))
        .drop("_tail", "_raw_token", "_token", "_number", "_plain")
    )


def amount_changed(new: Column, previous: Column) -> Column:
    """Whether two amounts differ at one place; an unknown side counts as no."""
    return F.coalesce(round_one(new) != round_one(previous), F.lit(False))
