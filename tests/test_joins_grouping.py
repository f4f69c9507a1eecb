"""Lookup joins under skew, first matches, carry-over, distinct values."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from gapledger.operators.columns import renamed, with_default
from gapledger.operators.grouping import distinct_join_count, first_seen, values_not_in
from gapledger.operators.joins import carry_over, first_per_key, lookup_left


def facts(spark, rows=60_000):
    """A third of the facts on one key, a third without key."""
    return spark.range(rows).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"),
    )


def lookup(spark):
    return spark.range(500).select(F.concat(F.lit("k"), F.col("id")).alias("lk"), F.col("id").alias("v")).union(
        spark.createDataFrame([("hot", -1), (None, -2)], "lk string, v bigint")
    )


def test_shuffled_lookup_keeps_every_fact_and_scatters_null_keys(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    joined = lookup_left(facts(spark), lookup(spark), "k", "lk", "id")
    assert joined.columns == ["id", "k", "lk", "v"]
    rows = joined.collect()
    assert len(rows) == 60_000 and len({r.id for r in rows}) == 60_000
    for r in rows:
        assert r.v == (None if r.k is None else -1 if r.k == "hot" else int(r.k[1:]))
    nulls = joined.filter("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
    assert len(nulls) == 8 and max(r["count"] for r in nulls) < 20_000 / 4
    # The optimizer must not take the scattering key away, whatever the lookup is.
    for right in (lookup(spark), lookup(spark).distinct(), lookup(spark).filter("lk IS NOT NULL")):
        plan = lookup_left(facts(spark), right, "k", "lk", "id")._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"SortMergeJoin \[k#\d+, _spread#\d+L\]", plan)


def test_keys_of_different_types_are_refused(spark):
    left = spark.createDataFrame([(1, 2)], "id int, k int")
    with pytest.raises(TypeError):
        lookup_left(left, spark.createDataFrame([(2,)], "lk bigint"), "k", "lk", "id")


def test_hot_key_is_split_by_adaptive_execution(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__shuffle__partitions="40",
    )
    # Many map tasks, since a skewed partition is split between their outputs.
    wide = facts(spark, 90_000).withColumn("text", F.sha2(F.col("id").cast("string"), 512)).repartition(16)
    rows = lookup_left(wide, lookup(spark), "k", "lk", "id").agg(
        F.count("*").alias("n"), F.sum(F.when(F.col("k") == "hot", F.col("v"))).alias("hot"), F.max("text")
    )
    result = rows.collect()[0]
    assert (result.n, result.hot) == (90_000, -30_000)
    assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()


def test_duplicate_lookup_rows_multiply_facts(spark):
    left = spark.createDataFrame([(1, "a"), (2, None)], "id int, k string")
    right = spark.createDataFrame([("a", 1), ("a", 2)], "lk string, v int")
    assert sorted((r.id, r.v) for r in lookup_left(left, right, "k", "lk", "id").collect() if r.v) == [(1, 1), (1, 2)]


def test_first_per_key(spark):
    rows = [(1, 9, "late"), (1, 7, "first"), (2, 8, "only"), (None, 1, "no key"), (1, 12, "last")]
    df = spark.createDataFrame(rows, "k int, pos int, t string")
    found = first_per_key(df, "k", "pos")
    assert sorted((r.k, r.t) for r in found.collect()) == [(1, "first"), (2, "only")]
    # One row per key and task is kept before the shuffle.
    assert "WindowGroupLimit" in found._jdf.queryExecution().executedPlan().toString()


def test_carry_over_takes_nulls_too(spark):
    df = spark.createDataFrame(
        [("new", 1, True, "old", 2), ("new", 1, True, None, None), ("new", 1, False, None, None)],
        "a string, b int, m boolean, pa string, pb int")
    found = carry_over(df, F.col("m"), {"a": "pa", "b": "pb"})
    assert [tuple(r) for r in found.collect()] == [("old", 2, True), (None, None, True), ("new", 1, False)]


def test_distinct_values(spark):
    df = spark.createDataFrame([("x", "b", 1), ("x", "a", 2), ("x", "b", None), ("y", None, 3)], "k string, c string, d int")
    found = {r.k: (r.c, r.d, r["count"]) for r in distinct_join_count(df, ["k"], ["c", "d"]).collect()}
    assert found == {"x": ("a,b", "1,2", 3), "y": ("", "3", 1)}
    seen = first_seen(df, "c", F.col("d")).orderBy("first_seen").collect()
    assert [(r.c, r.first_seen) for r in seen] == [("b", 1), ("a", 2)]
    assert {r.d for r in values_not_in(df, "d", (1, 2)).collect()} == {None, 3}


def test_schema_dependent_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert with_default(df, "b", 0, "int").first() == (1, 0)
    assert with_default(df, "a", 0, "int").first() == (1,)
    assert renamed(df, {"a": "x", "missing": "y"}).columns == ["x"]
