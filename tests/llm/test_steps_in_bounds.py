"""What a step may hold or make at once: shuffled files, members of blocks, bytes of runs."""

from __future__ import annotations

import os
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gapledger.llm import components, near_dedup, suffix_dedup
from gapledger.llm.staging import FILE_ROWS, in_few_files, staged


def _shuffled(spark):
    """Names of the shuffle files that the session has."""
    folder = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for top in folder for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_") and f.endswith(".data")}


def test_a_staged_table_leaves_no_shuffle_files(spark):
    before = _shuffled(spark)
    table = staged(spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count())
    assert not _shuffled(spark) - before
    assert table.count() == 7
    # A later query of the same frame shuffles anew.
    frame = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert staged(frame).count() == frame.count() == staged(frame).count() == 7


def test_few_rows_are_written_in_few_files(spark):
    cores = spark.sparkContext.defaultParallelism
    made = spark.range(0, 1000, 1, 50)
    table = staged(made, 1000)
    assert table.count() == 1000 and len(table.inputFiles()) <= cores
    assert len(staged(made).inputFiles()) == 50
    # Many rows keep their partitions, and none are added.
    assert in_few_files(made, 50 * FILE_ROWS).rdd.getNumPartitions() == 50
    assert in_few_files(made, 20 * FILE_ROWS + 1).rdd.getNumPartitions() == max(cores, 21)
    assert in_few_files(spark.range(0, 10, 1, 2), 50 * FILE_ROWS).rdd.getNumPartitions() == 2


def test_near_dedup_writes_its_rounds_in_few_files(spark, settings, monkeypatch):
    """Each of some forty tables had a file for each shuffle partition, however few its rows."""
    settings(spark__sql__shuffle__partitions="60", spark__sql__adaptive__coalescePartitions__enabled="false")
    files = []

    def counted(*of, **options):
        table = staged(*of, **options)
        files.append(len(table.inputFiles()))
        return table

    monkeypatch.setattr(near_dedup, "staged", counted)
    monkeypatch.setattr(components, "staged", counted)
    words = [f"w{k}" for k in range(60)]
    # Classes of 4 texts that differ in one word each; a class has words of its own.
    rows = [(4 * c + k, " ".join([f"{w}x{c}" for w in words[:-1]] + [f"own{k}"])) for c in range(50) for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    found = near_dedup.near_duplicate_classes(docs, pairs_per_text=0)
    assert {r.doc_id: r.class_id for r in found.collect()} == {d: d - d % 4 for d, _ in rows}
    assert len(files) > 8 and max(files) <= spark.sparkContext.defaultParallelism


def test_members_of_a_bucket_for_one_block_stand_once(spark):
    held = spark.range(3_000).select(
        F.lit(1).alias("band"), F.lit(5).cast("long").alias("hash"), "id", F.lit(40).cast("long").alias("total")
    )
    assert near_dedup.dealt_members(held, near_dedup.BLOCK, near_dedup.BLOCK_BYTES).count() == 3_000
    assert near_dedup.dealt_members(held, 1_000, near_dedup.BLOCK_BYTES).count() == 9_000


def test_tiles_find_the_links_of_all_pairs():
    rng = np.random.default_rng(5)
    base = [np.unique(rng.integers(0, 1 << 40, n)).astype(np.uint64) for n in (10, 25, 60)]
    sets = []
    for k in range(60):
        own = base[k % 3]
        sets.append(np.unique(np.r_[own[: len(own) - k % 4], rng.integers(0, 1 << 40, k % 3).astype(np.uint64)]))
    for one, other in ((np.arange(60), None), (np.arange(0, 60, 2), np.arange(1, 60, 2))):
        other = one if other is None else other
        label = list(range(60))
        for a in one:
            for b in other:
                if len(np.intersect1d(sets[a], sets[b])) / len(np.union1d(sets[a], sets[b])) >= 0.8:
                    least, most = sorted((label[a], label[b]))
                    label = [least if x == most else x for x in label]
        for tile in (1, 7, 1024):
            assert (near_dedup.tile_links(sets, one, other, 0.8, tile) == label).all()


def test_portions_hold_whole_anchors():
    anchor = np.repeat([1, 2, 5, 9], [3, 700, 2, 1])
    assert suffix_dedup.anchor_portions(anchor, 4) == [(0, 703), (703, 706)]
    assert suffix_dedup.anchor_portions(anchor, 2) == [(0, 3), (3, 703), (703, 705), (705, 706)]
    assert suffix_dedup.anchor_portions(anchor[:0]) == []


def test_a_bucket_is_ordered_in_bounded_memory(spark):
    """A bucket's runs were brought into order at once, with some hundred bytes for each of theirs."""
    rng = np.random.default_rng(2)
    data = [rng.integers(97, 123, 300).astype(np.uint8).tobytes() for _ in range(4_000)]
    rows = pa.table({
        "id": np.arange(4_000), "h": np.zeros(4_000, np.int64), "a": np.arange(4_000) // 2,
        "low": np.zeros(4_000, np.int32), "bytes": [data[i - i % 2] for i in range(4_000)],
    })
    kept = []

    class Frame:
        """Takes the function that Spark would call for each bucket."""

        schema = spark.range(1).schema

        def withColumn(self, *_):
            return self

        def groupBy(self, *_):
            return self

        def applyInArrow(self, order, _):
            tracemalloc.start()
            kept.append(order(rows))
            kept.append(tracemalloc.get_traced_memory()[1])
            tracemalloc.stop()

    suffix_dedup._bucket_spans(Frame(), 1, True, 200)
    found, peak = kept
    assert sorted(found["id"].to_pylist()) == list(range(1, 4_000, 2))
    assert set(found["start"].to_pylist()) == {0} and set(found["end"].to_pylist()) == {300}
    assert peak < 40e6
