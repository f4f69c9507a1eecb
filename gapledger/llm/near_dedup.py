"""Near-duplicate classes by DartMinHash, banding and exact verification.

Texts with the same words are one text here, named by its least id. Each has a
signature over its weighted five-word shingles; signatures are cut into bands, and
texts that share a band's hash share a bucket. A bucket is not expanded into pairs at
once: its members are compared with one centre, links are closed into components, and
what remains are buckets with members in different components. Rounds with
centres of small, newly dealt parts go on while those are many and get fewer. Then the
buckets that are left are compared whole, in blocks within a task and tile by tile there:
members against cells give the number of cells that each two members share, and only links
that join members not joined yet leave the task. So every pair that shares a bucket is compared exactly, or in
one class already; there is no limit on the size of a bucket or on pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapledger.llm.components import connected_components
from gapledger.llm.csr import ranges
from gapledger.llm.dart_minhash import band_hashes, dart_signatures
from gapledger.llm.embedding_dedup import joined_rows
from gapledger.llm.shingles import WordReader, as_set, jaccard, shingles
from gapledger.llm.staging import in_few_files, remove_table, staged
from gapledger.llm.text import free_name
from gapledger.llm.workers import slices

SIMILARITY = 0.8
#: 32 bands of 6: of pairs at 0.8, one in 17,000 shares no band.
BANDS, ROWS = 32, 6
#: All remaining pairs are compared once they are at most so many per text, or once a round
#: with other centres leaves more than this share of them.
PAIRS_PER_TEXT, STALLED = 1, 0.75
#: Members of the parts that buckets are dealt into, on average.
PART = 8
#: Members of a block, and bytes of their cells.
BLOCK, BLOCK_BYTES = 4096, 32 << 20
#: Members that are compared with as many others at a time, within a task.
TILE = 1024
#: Columns of members against cells that are multiplied at a time; pairs from other columns.
_COLUMNS, _PAIRS = 2048, 4_000_000
_SLICE = 1_000_000


def _sketch(part: list[str], reader: WordReader, bands: int, rows: int) -> list[dict]:
    import xxhash

    found, sets = [], []
    for text in part:
        words = reader.words(text)
        values = shingles(words)
        found.append({"digest": xxhash.xxh3_128_digest(words.tobytes()), "total": len(values), "bands": []})
        sets.append(np.unique(values, return_counts=True))
    full = [i for i, (values, _) in enumerate(sets) if len(values)]
    if full:
        elements = np.concatenate([sets[i][0] for i in full])
        weights = np.concatenate([sets[i][1] for i in full]).astype(np.float64)
        owner = np.repeat(np.arange(len(full)), [len(sets[i][0]) for i in full])
        signatures = dart_signatures(elements, weights, owner, len(full), bands * rows)
        for i, row in zip(full, band_hashes(signatures, rows).view(np.int64).tolist(), strict=True):
            found[i]["bands"] = row
    return found


_SKETCH = pa.struct([("digest", pa.binary()), ("total", pa.int64()), ("bands", pa.list_(pa.int64()))])


def _sketches(texts: DataFrame, bands: int, rows: int) -> DataFrame:
    def sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = WordReader()
        for batch in batches:
            found = []
            for part in slices(batch, _SLICE):
                found += _sketch(part, reader, bands, rows)
            yield pa.array(found, _SKETCH)

    sketch.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    made = F.arrow_udf(sketch, "struct<digest:binary,total:long,bands:array<long>>").asNondeterministic()
    return texts.select("id", made(F.col("text")).alias("s")).select("id", "s.*")


def _shingle_sets(texts: DataFrame) -> DataFrame:
    """``id, cells``: the multiset of shingles as sorted 64-bit hashes in bytes."""

    def cells(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = WordReader()
        for batch in batches:
            yield pa.array([as_set(shingles(reader.words(t.as_py() or ""))).tobytes() for t in batch], pa.binary())

    cells.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    made = F.arrow_udf(cells, "binary").asNondeterministic()
    return texts.select("id", made(F.col("text")).alias("cells"))


def _similar(one: pa.Array, other: pa.Array) -> pa.Array:
    read = lambda x: np.frombuffer(x.as_py(), np.uint64)
    return pa.array([jaccard(read(a), read(b)) for a, b in zip(one, other, strict=True)], pa.float64())


_similar.__annotations__ = {"one": pa.Array, "other": pa.Array, "return": pa.Array}


def _may_be_similar(total_a: Column, total_b: Column, similarity: float) -> Column:
    """Weighted Jaccard similarity is at most the smaller total over the larger."""
    return F.least(total_a, total_b) >= F.greatest(total_a, total_b) * F.lit(similarity)


def common_cells(one: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """How many cells each set of ``one`` shares with each of ``other``.

    Cells that many members have are columns of two matrices that are multiplied, some at a
    time; for the others, the few pairs of members that share each are counted.
    """
    lengths = [np.array([len(c) for c in side]) for side in (one, other)]
    _, at = np.unique(np.concatenate([*one, *other]), return_inverse=True)
    at = at[: lengths[0].sum()], at[lengths[0].sum() :]
    owner = [np.repeat(np.arange(len(n)), n) for n in lengths]
    wide = max(int(a.max(initial=-1)) for a in at) + 1
    held = [np.bincount(a, minlength=wide) for a in at]
    common = np.zeros((len(one), len(other)), np.float32)
    work = held[0] * held[1]
    often = work > len(one) * len(other) / 100
    columns = np.flatnonzero(often)
    number = np.full(wide, -1)
    for first in range(0, len(columns), _COLUMNS):
        some = columns[first : first + _COLUMNS]
        number[some] = np.arange(len(some))
        sides = []
        for a, of, n in zip(at, owner, (len(one), len(other)), strict=True):
            own = number[a] >= 0
            side = np.zeros((n, len(some)), np.float32)
            side[of[own], number[a[own]]] = 1
            sides.append(side)
        common += sides[0] @ sides[1].T
        number[some] = -1
    few = np.flatnonzero((work > 0)[at[0]] & ~often[at[0]])
    order = np.argsort(at[1], kind="stable")
    starts = np.cumsum(held[1]) - held[1]
    each = held[1][at[0][few]]
    ends = np.cumsum(each)
    begun = 0
    while begun < len(few):
        stop = max(int(np.searchsorted(ends, (ends[begun - 1] if begun else 0) + _PAIRS, "right")), begun + 1)
        part = few[begun:stop]
        partner = owner[1][order[ranges(starts[at[0][part]], each[begun:stop])]]
        pair = np.repeat(owner[0][part], each[begun:stop]) * len(other) + partner
        common += np.bincount(pair, minlength=common.size).reshape(common.shape).astype(np.float32)
        begun = stop
    return common


def linked_sets(one: list[np.ndarray], other: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Which sets of ``one`` have a Jaccard similarity of at least ``similarity`` to which of ``other``."""
    common = common_cells(one, other).astype(np.float64)
    sizes = [np.array([len(c) for c in side], np.float64) for side in (one, other)]
    return np.nonzero(common / (sizes[0][:, None] + sizes[1][None, :] - common) >= similarity)


def tile_links(sets: list[np.ndarray], one: np.ndarray, other: np.ndarray, similarity: float, tile: int = TILE) -> np.ndarray:
    """For each of ``sets`` the least one it is joined to by links between those numbered ``one`` and ``other``.

    Both sides are cut into tiles in order of size, as sets of too different sizes are never similar.
    Of a tile's links only those are kept that join its members, so their number does not grow
    with the pairs.
    """
    sizes = np.array([len(s) for s in sets])
    sides = [side[np.argsort(sizes[side], kind="stable")] for side in (one, other)]
    cut = [[side[k : k + tile] for k in range(0, len(side), tile)] for side in sides]
    ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k, low in enumerate(cut[0]):
        for high in cut[1][k if one is other else 0 :]:
            if min(sizes[low[-1]], sizes[high[-1]]) / max(sizes[low[0]], sizes[high[0]], 1) < similarity:
                continue
            i, j = linked_sets([sets[x] for x in low], [sets[x] for x in high], similarity)
            members = np.concatenate([low, high])
            label = joined_rows(len(members), i, len(low) + j)
            ends[0].append(members)
            ends[1].append(members[label])
    return joined_rows(len(sets), np.concatenate(ends[0]), np.concatenate(ends[1]))


def dealt_members(held: DataFrame, block: int, block_bytes: int) -> DataFrame:
    """``band, hash, low, high, own, id``: members of the buckets of ``held``, for each two blocks of a bucket.

    Blocks are dealt by the members' hash. A member stands once for each block of its bucket, so
    once in all where one block has the bucket.
    """
    sizes = held.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("n"), (8 * F.sum("total")).alias("bytes"))
    blocks = F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("bytes") / block_bytes)).cast("int").alias("blocks")
    dealt = held.select("band", "hash", "id").join(sizes.select("band", "hash", blocks), ["band", "hash"])
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("id", "band"), F.col("blocks")).cast("int"))
    return dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "band", "hash", F.least("own", "with").alias("low"), F.greatest("own", "with").alias("high"), "own", "id"
    )


def _bucket_links(held: DataFrame, sets: DataFrame, similarity: float, block: int, block_bytes: int) -> DataFrame:
    """``a, b``: links that join the members of each bucket of ``held`` as all their links would.

    A bucket too large for one task is dealt into blocks by its members' hash; each task
    then has two blocks, or one.
    """

    def compare(table: pa.Table) -> pa.Table:
        ids, own = table.column("id").to_numpy(), table.column("own").to_numpy()
        cells = [np.frombuffer(c.as_py(), np.uint64) for c in table.column("cells")]
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        one = np.flatnonzero(own == low)
        other = one if low == high else np.flatnonzero(own == high)
        label = tile_links(cells, one, other, similarity)
        moved = np.flatnonzero(label != np.arange(len(ids)))
        return pa.table({"a": ids[moved], "b": ids[label[moved]]})

    members = dealt_members(held, block, block_bytes).join(sets, "id").groupBy("band", "hash", "low", "high")
    return members.applyInArrow(compare, "a long, b long").distinct()


def _links(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of ``pairs`` (``a, b, total_a, total_b``) that are similar enough, compared exactly."""
    may = _may_be_similar(F.col("total_a"), F.col("total_b"), similarity)
    pairs = pairs.filter(may).select("a", "b").distinct()
    one = sets.select(F.col("id").alias("a"), F.col("cells").alias("cells_a"))
    other = sets.select(F.col("id").alias("b"), F.col("cells").alias("cells_b"))
    compared = pairs.join(one, "a").join(other, "b")
    found = F.arrow_udf(_similar, "double").asNondeterministic()("cells_a", "cells_b")
    return compared.select("a", "b", found.alias("s")).filter(F.col("s") >= similarity).select("a", "b")


def near_duplicate_classes(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", similarity: float = SIMILARITY,
    bands: int = BANDS, rows: int = ROWS, pairs_per_text: int = PAIRS_PER_TEXT, block: int = BLOCK,
) -> DataFrame:
    """``<id>, class_id`` for each row of ``docs``: the least id of its class.

    Classes are the connected components of pairs whose weighted Jaccard similarity of
    five-word shingles is at least ``similarity``; equal word sequences always are.
    Texts without words (null, empty, marks only) are near no other: each is its own
    class. A null id has a null class. Repeated ids share the classes of all their
    texts' ids; other columns are not read.
    """
    texts = docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")
    )
    known = texts.filter("id IS NOT NULL")
    sketches = staged(_sketches(known, bands, rows))
    count = sketches.count()
    worded = sketches.filter("total > 0")
    first = worded.groupBy("digest").agg(F.min("id").alias("rep"))
    of = worded.select("id", "digest", "total", "bands").join(first, "digest")
    members = of.select("id", "rep")

    keyed = of.filter("id = rep").select(F.col("rep").alias("id"), "total", F.posexplode("bands").alias("band", "hash"))
    buckets = keyed.groupBy("band", "hash").agg(F.min("id").alias("least"), F.max("id").alias("most"))
    buckets = buckets.filter("least <> most").select("band", "hash")
    shared = staged(keyed.join(buckets, ["band", "hash"]), bands * count)
    nodes = staged(shared.select("id").distinct(), count)
    sets = staged(_shingle_sets(known.join(nodes, "id")))
    labels = nodes.select("id", F.col("id").alias("label"))
    enough = pairs_per_text * count

    turn, before, most = 0, 0, shared.count()
    held = shared.withColumn("label", F.col("id"))
    while True:
        sizes = held.groupBy("band", "hash", "label").agg(F.count(F.lit(1)).alias("n"))
        split = staged(sizes.groupBy("band", "hash").agg(
            F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("same"), F.count(F.lit(1)).alias("labels")
        ).filter("labels > 1"), most)
        open_pairs = split.agg(F.sum((F.col("n") * F.col("n") - F.col("same")) / 2)).first()[0] or 0
        if not open_pairs:
            break
        left = held.join(split.select("band", "hash"), ["band", "hash"])
        last = open_pairs <= enough or (turn > 1 and open_pairs > STALLED * before)
        before = open_pairs
        if last:
            found = _bucket_links(left, sets, similarity, block, BLOCK_BYTES)
        else:
            # At first a bucket's centre is its least id. Later a bucket is dealt anew each round into
            # parts with a centre each, so that a member meets others in each of its bands.
            parts = F.ceil(F.col("n") / PART) if turn else F.lit(1)
            cut = held.join(split.select("band", "hash", parts.alias("parts")), ["band", "hash"])
            cut = cut.withColumn("part", F.pmod(F.xxhash64("id", "band", F.lit(turn)), "parts"))
            centres = cut.groupBy("band", "hash", "part").agg(F.min(F.struct("id", "total", "label")).alias("c"))
            pairs = cut.join(centres, ["band", "hash", "part"]).filter("label <> c.label").select(
                F.least("id", "c.id").alias("a"), F.greatest("id", "c.id").alias("b"),
                F.col("total").alias("total_a"), F.col("c.total").alias("total_b"),
            )
            # Compared in many tasks, written by few.
            found = _links(pairs, sets, similarity).repartition("a")
        links, former = staged(found, most), labels
        labels = _merged(labels, links, count)
        # A closed bucket stays closed, so the next round reads the open ones alone, which get
        # their labels once. What the round has staged goes before the next one stages as much.
        done = [links, split] + ([former, held] if turn else [shared])
        if not last:
            held = staged(left.drop("label").join(labels, "id"), most)
        for table in done:
            remove_table(table)
        turn += 1
        if last:
            break

    labels = labels.select(F.col("id").alias("rep"), "label")
    classes = members.join(labels, "rep", "left").select("id", F.coalesce("label", "rep").alias("class_id"))
    lone = sketches.filter("total = 0").select("id", F.col("id").alias("class_id"))
    nameless = texts.filter("id IS NULL").select("id", F.col("id").alias("class_id"))
    return in_few_files(classes, count).union(lone).union(nameless).withColumnRenamed("id", id_column)


def _merged(labels: DataFrame, links: DataFrame, rows: int) -> DataFrame:
    """``labels``, at most ``rows`` of them, after the classes of linked ids have become one."""
    of = lambda end: labels.select(F.col("id").alias(end), F.col("label").alias(f"label_{end}"))
    between = links.join(of("a"), "a").join(of("b"), "b").select(
        F.col("label_a").alias("a"), F.col("label_b").alias("b")
    )
    joined = connected_components(between, links.count())
    joined = joined.select(F.col("node").alias("label"), F.col("label").alias("_to"))
    return staged(labels.join(joined, "label", "left").select("id", F.coalesce("_to", "label").alias("label")), rows)


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """One row of ``docs`` of each class stays, that with the least id; columns as they were.

    Rows of which the id is null stay.
    """
    gone = near_duplicate_classes(docs, id_column, text_column, **options)
    name = free_name(docs, "_gone")
    gone = gone.filter(F.col(id_column) != F.col("class_id")).select(F.col(id_column).alias(name)).distinct()
    return docs.join(gone, F.col(id_column) == F.col(name), "left_anti")
