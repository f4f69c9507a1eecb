"""Row numbers without a one-task window."""

from __future__ import annotations

from pyspark.sql import functions as F

from gapledger.operators.numbering import number_rows


def skewed(spark, rows: int = 30_000):
    """A third of the rows in group 'hot', another share without group."""
    return spark.range(rows).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None)
        .otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("v"),
    ).repartition(8)


def test_global_numbers_follow_the_order(spark):
    numbered = number_rows(skewed(spark), [F.col("v").desc(), F.col("id").asc()], "n")
    rows = numbered.orderBy("n").collect()
    assert [r.n for r in rows] == list(range(1, 30_001))
    assert [(r.v, r.id) for r in rows] == sorted(((r.v, r.id) for r in rows), key=lambda p: (-p[0], p[1]))


def test_group_numbers_restart_and_split_a_hot_group(spark, settings):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    numbered = number_rows(skewed(spark), [F.col("v").asc(), F.col("id").asc()], "n", ["g"])
    rows = numbered.collect()
    assert len(rows) == 30_000
    groups: dict = {}
    for r in rows:
        groups.setdefault(r.g, []).append(r)
    assert len(groups["hot"]) == 10_000 and None in groups
    for members in groups.values():
        members.sort(key=lambda r: r.n)
        assert [r.n for r in members] == list(range(1, len(members) + 1))
        assert [(r.v, r.id) for r in members] == sorted((r.v, r.id) for r in members)
    # The hot group lies in several tasks, none of which holds most of it.
    spread = (
        number_rows(skewed(spark), [F.col("v").asc(), F.col("id").asc()], "n", ["g"])
        .filter("g = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    )
    assert len(spread) > 1 and max(r["count"] for r in spread) < 10_000


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], "a int, g string")
    assert number_rows(empty, [F.col("a").asc()], "n").collect() == []
    assert number_rows(empty, [F.col("a").asc()], "n", ["g"]).collect() == []
    one = spark.createDataFrame([(5, "x")], "a int, g string")
    assert number_rows(one, [F.col("a").asc()], "n", ["g"]).first().n == 1
