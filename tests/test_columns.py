"""Column helpers on hand-written values."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from gapledger.config import ApprovalRules
from gapledger.functions import amounts, dates, identity, labels, titles
from gapledger.sources.extracts import approval_link, id_of_link

RULES = ApprovalRules(as_of_time=dt.datetime(2001, 6, 20, 9, 0))


def evaluate(spark, build, values, type_name="string"):
    """The expression over one column ``x``, in input order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {type_name}")
    return [r[0] for r in df.select(build(F.col("x")).alias("y"), "i").orderBy("i").drop("i").collect()]


AMOUNTS = {
    "$5MM": 5.0, "($1,5M)": 1.5, "$ 250K": 0.2, "$1,234,567": 1.2, "$1,234,": 0.0, "$1.2.3M": None,
    "$1.2.3": None, "$": None, "$0.25M": 0.2, "$750 total K": 0.8, "$3 M": 3.0, "$1,234M": None,
    "$1,234K": None, "no amount": None, "": None, "$   ": None, "$$7M": 7.0, "Site $12.35MM later": 12.3,
    "$1_000K": 1.0, "$5M,": 5.0, "$1,5M,": 1.5, "$1,2,3,": 0.0, "$1,,3,": 0.0, "$12d": None, "$abc": None,
    "$-4M": -4.0, "$1e3K": 1.0, "$90,000,000": 90.0, "$20000000000 M": 20000.0, "two $1M and $9M": 1.0,
    "$2k": 0.0, "$900k": 0.9, "$5 ": 0.0, "$0.35M": 0.3, "$1.45M": 1.4, "$\n5M": 5.0,
}


def test_amount(spark):
    df = spark.createDataFrame(list(enumerate(AMOUNTS)), "i int, t string")
    found = amounts.with_amount(df, "t", "a").orderBy("i").collect()
    assert {r.t: r.a for r in found} == AMOUNTS
    assert amounts.with_amount(df, "t", "a").columns == ["i", "t", "a"]


def read_amount(title: str) -> float | None:
    """The amount rules again, on Python's own numbers."""
    _, dollar, rest = title.partition("$")
    rest = rest.lstrip(" ")
    if not dollar or not rest:
        return None
    token = "".join(c for c in rest.split(" ")[0] if c not in ")$")
    head, comma, after = token.rpartition(",")
    numerics = sum(c in "0123456789." for c in after)
    if comma and numerics == 0:
        before, inner, last = (head + after).rpartition(",")
        token = f"{before}.{last}" if inner else last
    elif comma and numerics < 3:
        token = f"{head}.{after}"
    own_unit = next((u for u in (("M", 1), ("Kk", 1000)) if set(u[0]) & set(token)), None)
    letters, divisor = own_unit or (",", 1000000)
    try:
        value = float("".join(c for c in token if c not in letters)) / divisor
    except ValueError:
        return None
    if own_unit is None and value < 10000:
        value *= next((by for u, by in (("M", 1000000), ("Kk", 1000)) if set(u) & set(rest)), 1)
    # No report shows an infinite amount.
    return round(value, 1) if math.isfinite(value) else None


def test_amount_agrees_with_python_on_random_titles(spark):
    rng = random.Random(7)
    pieces = ["$", " ", ",", ".", "M", "MM", "K", "k", ")", "(", "1", "25", "0", "999", "_", "-", "e", "x", "total", "\n"]
    made = {"".join(rng.choices(pieces, k=rng.randint(1, 9))) for _ in range(6000)}
    made |= {f"Site ${rng.choice(['', ' '])}{rng.randint(0, 10**rng.randint(1, 9)):,}{tail}"
             for tail in ("", "M", " M", "K", ".5K", ",", " k x", ".25", ".05M") for _ in range(60)}
    made = sorted(made)
    df = spark.createDataFrame(list(enumerate(made)), "i int, t string")
    found = [r.a for r in amounts.with_amount(df, "t", "a").orderBy("i").collect()]
    wrong = [(t, a, read_amount(t)) for t, a in zip(made, found) if a != read_amount(t)]
    assert wrong == []


def test_round_one_is_half_even_on_the_binary_value(spark):
    rng = random.Random(3)
    values = [0.25, 0.35, 1.45, 2.5, -0.25, 1e12 + 0.05, 0.0] + [rng.uniform(-1e6, 1e6) for _ in range(2000)]
    values += [n / 20 for n in range(-400, 400)]
    found = evaluate(spark, amounts.round_one, values, "double")
    assert found == [round(v, 1) for v in values]


def test_amount_changed_is_no_when_a_side_is_unknown(spark):
    df = spark.createDataFrame([(1.0, 1.04), (1.0, 1.06), (None, 1.0), (1.0, None), (None, None)], "a double, b double")
    found = [r[0] for r in df.select(amounts.amount_changed(F.col("a"), F.col("b"))).collect()]
    assert found == [False, True, False, False, False]


def test_plan_years(spark):
    cases = {
        "NA  2001 x": "2001", "NA _2002_x": "2002", "NA FY2003 x": "2003", "NA 2000 2001 x": "2000, 2001",
        "NA undated x": "", " 2001 FY2003 ": "2001", "FY2003 FY2002 FY2003 ": "2002, 2003", "2001_2002_": "2001, 2002",
        " 1998 2006 ": "", " 2005 1999 ": "1999, 2005", "": "", "20012002 ": "2002",
    }
    df = spark.createDataFrame(list(cases.items()), "t string, expected string")
    found = dates.with_plan_years(df, "t", dt.date(2001, 6, 20), "y")
    assert found.columns == ["t", "expected", "y"]
    assert {r.t: r.y for r in found.collect()} == cases


@pytest.mark.parametrize("template, title, expected", [
    (0, "EU x", "EU"), (0, "NA", "NA"), (0, "JP x", "AP"), (0, "MX", "EC"), (0, "12 IN ", "AP"), (0, "zz", "Check"),
    (0, "eu", "Check"), (0, "", "Check"), (0, "123", "Check"), (0, "SIN1", "Check"), (0, "Check", "Check"),
    (0, "(BR)", "EC"), (0, "ſEU", "Check"), (7394, "EU", "EC"), (37508, "NA", "EU"), (39820, "", "NA"),
    (39171, "AU", "EC"), (0, "E\nU", "Check"), (None, "AP", "AP"),
])
def test_region(spark, template, title, expected):
    df = spark.createDataFrame([(template, title)], "template_id int, t string")
    assert df.select(titles.region(F.col("t"), F.col("template_id"), RULES)).first()[0] == expected


def test_request_type(spark):
    cases = {
        "Startup": "SU", "x SU y": "SU", "xSU y": None, "STARTUP real estate": "RE & SU", "a SU RE b": "RE & SU",
        "a SU b RE c": "RE & SU", "Real Estate": "RE", "construction": "RE", "x CN y": "RE", "INITIATIVE": "Initiative",
        "initiative construction": "RE", "": None, "other": None,
    }
    assert evaluate(spark, lambda t: titles.request_type(t, F.lower(t)), cases) == list(cases.values())


def test_site_codes_and_tags(spark):
    cases = {"ABC1 ARS4 ABC1 XYZ9": "ABC1, XYZ9", "AARS4": "", "ABCD12": "BCD1", "TNS8 abc1": "", "ABC1DEF2": "ABC1, DEF2"}
    assert evaluate(spark, lambda t: titles.site_codes(t, RULES.site_stems_excluded), cases) == list(cases.values())
    tags = {"ARS450 3PL": "ARS ARS450 3PL", "none": "", "IXD TSSL Mixed Sort": "IXD Mixed Sort TSSL"}
    assert evaluate(spark, lambda t: titles.keyword_tags(t, RULES.building_types, " "), tags) == list(tags.values())
    full = {"Construction Lease Renewal": "Construction and Lease Renewal"}
    assert evaluate(spark, lambda t: titles.keyword_tags(t, RULES.request_types, " and "), full) == list(full.values())


def test_clean_title(spark):
    cases = {"[EU] a &ndash; b &amp; c": "EU a - b & c", "&amp;ndash;": "&ndash;", None: None}
    assert evaluate(spark, titles.clean_title, cases) == list(cases.values())


def python_business_days(day: dt.date, as_of: dt.date, first: int) -> int:
    """Count days and week starts one by one."""
    later = [day + dt.timedelta(days=n) for n in range(1, (as_of - day).days + 1)]
    return len(later) - 2 * sum(d.weekday() == first for d in later)


@pytest.mark.parametrize("week_start, first", [("monday", 0), ("sunday", 6)])
def test_business_days(spark, week_start, first):
    days = [dt.date(2022, 9, 1) + dt.timedelta(days=n) for n in range(40)]
    for as_of in (dt.date(2022, 10, 10), dt.date(2022, 10, 15), dt.date(2022, 10, 16)):
        found = evaluate(spark, lambda d: dates.business_days_since(d, as_of, week_start), days, "date")
        assert found == [python_business_days(d, as_of, first) for d in days]
    with pytest.raises(ValueError):
        dates.week_boundaries(F.col("x"), dt.date(2022, 10, 10), "tuesday")


def test_dates_as_text(spark, settings):
    texts = ["2022-10-07", "2022-10-07T10:00:00", "2022-10-07junk", "2022-13-07", "", None, "x", "2022", "2022-10"]
    assert evaluate(spark, dates.text_date, texts) == [dt.date(2022, 10, 7)] * 3 + [None] * 6
    bad = [
        "12-01x2022 05:00:00", "12-01-2022T05:00:00", "12-01-2022 05:00:0Z", "12-01-2022 5:00:00Z",
        "12-01-2022 05:00   ", "12-01-2022 05:00:00\n", "13-01-2022 05:00:00", "", None,
    ]
    assert evaluate(spark, dates.needed_by_utc, bad) == [None] * len(bad)
    good = ["12-01-2022 05:00:00", "2-1-2022 5:0:0"]
    assert evaluate(spark, dates.needed_by_utc, good) == [dt.datetime(2022, 12, 1, 5), dt.datetime(2022, 2, 1, 5)]
    needed = ["12-01-2022 05:00:00", "12-01-2022 15:30:00", "07-04-2022 06:59:59", "02-31-2022 00:00:00", "soon", None,
              "7-4-2022 7:00:00", "12/01/2022 05:00:00", "2022-12-01 05:00:00", ""]
    shown = ["30-Nov, 2022", "01-Dec, 2022", "03-Jul, 2022", None, None, None, "04-Jul, 2022", None, None, None]

    def display(text):
        return dates.display_date(dates.local_date(dates.needed_by_utc(text), "America/Los_Angeles"))

    for zone in ("UTC", "Asia/Tokyo", "America/New_York"):
        settings(spark__sql__session__timeZone=zone)
        assert evaluate(spark, display, needed) == shown
        assert evaluate(spark, lambda d: dates.past_due(d, dt.datetime(2001, 6, 20, 9)), [
            dt.date(2001, 6, 19), dt.date(2001, 6, 20), dt.date(2001, 6, 21)], "date") == [True, True, False]
        assert evaluate(spark, lambda _: dates.data_cut_label(dt.datetime(2001, 6, 20, 15, 5)), ["x"]) == [
            "Data cut on 2001-06-20 at 03 PM"]
    assert evaluate(spark, dates.parse_display_date, ["30-Nov, 2022"]) == [dt.date(2022, 11, 30)]


def test_labels(spark):
    assert evaluate(spark, labels.label_total, ["a,b", "", "a", None, ","]) == [2, 1, 1, 0, 2]
    df = spark.createDataFrame(
        [(None, None, 0), ("c", None, 0), (None, "p", 0), (None, None, 2), ("c", "p", 0), (None, "p", 1), ("c", None, 1),
         ("c", "p", 3), (None, None, -1)], "c string, p string, n int")
    found = [r[0] for r in df.select(labels.missing_labels(F.col("c"), F.col("p"), F.col("n"))).collect()]
    assert found == ["Customer, Product, Sprint Tag", "Product, Sprint Tag", "Customer, Sprint Tag",
                     "Customer, Product", "Sprint Tag", "Customer", "Product", "No", "No"]
    df = spark.createDataFrame([("S13", "S1"), ("S1,S2", "S1"), (None, "S1"), ("S1", None)], "l string, s string")
    loose = [r[0] for r in df.select(labels.in_sprint(F.col("l"), F.col("s"))).collect()]
    exact = [r[0] for r in df.select(labels.in_sprint(F.col("l"), F.col("s"), exact=True)).collect()]
    assert loose == [True, True, False, False]
    assert exact == [False, True, False, False]


def test_people(spark):
    df = spark.createDataFrame(
        [("a", "m", "s"), ("a", "a", "s"), ("a", None, "s"), (None, "m", "s"), ("a", "a", None)],
        "a string, m string, s string")
    found = [r[0] for r in df.select(identity.responsible_manager(F.col("a"), F.col("m"), F.col("s"))).collect()]
    assert found == ["m", "s", None, "m", None]
    cleaned = evaluate(spark, lambda x: identity.clean_identity(x, "kerberos:", "@CORP.EXAMPLE"),
                       [" kerberos:ann@CORP.EXAMPLE ", "bob", None])
    assert cleaned == ["ann", "bob", None]


def test_links(spark):
    df = spark.createDataFrame([(12,)], "i bigint")
    link = df.select(approval_link(F.col("i"), "https://x.example/%7E/")).first()[0]
    assert link == '=HYPERLINK("https://x.example/%7E/12", 12)'
    texts = [link, "12", None, '=HYPERLINK("https://x.example/a, 9)", 77)']
    assert evaluate(spark, id_of_link, texts) == [12, 0, 0, 77]
