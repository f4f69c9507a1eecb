"""Near-duplicate vectors by sorted projection passes.

Equal vectors are one node. A pass gives each node a key, the signs of its projections on
random directions one after the other, and sorts nodes by it; a node is compared with those
up to ``WINDOW`` places after it. Pairs close in angle share long beginnings of their keys, so
some pass puts them near each other; the number of passes follows from the number of
nodes and the share of pairs that may be missed. Verified pairs are joined into components
within the task and then across tasks and passes; a pass gives out at most a row per node.

A crowd of near copies is wider than a window, so each component is then counted out in
full. Small ones are compared at once. In a large one, central nodes, within half the angle of
its mean direction, are all linked to each other, which needs no comparison; the outer ones
are compared with all in blocks, and only counts leave a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapledger.llm.components import connected_components
from gapledger.llm.staging import staged

SIMILARITY = 0.95
WINDOW = 64
#: Of lone pairs that are just similar enough, about this share meets in no pass.
MISSED = 0.001
#: Nodes compared with each other at a time.
BLOCK = 512
_BITS = 63
_STEP = 512
_SEAM = 1024
#: Angles closer to a bound than this are left to the comparison.
_SLACK = 1e-6


def passes_needed(nodes: int, similarity: float = SIMILARITY, window: int = WINDOW, missed: float = MISSED) -> int:
    """Passes until a lone pair at ``similarity`` is missed with probability ``missed``.

    Among ``nodes`` spread evenly, windows hold pairs that share the first log2(nodes / window)
    signs; two vectors share a sign with probability 1 - angle / pi.
    """
    shared = max(math.log2(max(nodes, 2) / window), 0.0)
    found = (1 - math.acos(similarity) / math.pi) ** shared
    return 1 if found >= 1 - missed else math.ceil(math.log(missed) / math.log1p(-found))


def unit_rows(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Directions in double precision, short ones filled up with zeros, and their lengths."""
    offsets = vectors.offsets.to_numpy()
    flat = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)[offsets[0] : offsets[-1]]
    sizes = np.diff(offsets)
    widest = int(sizes.max()) if len(sizes) else 0
    if (sizes == widest).all():
        x = flat.reshape(len(sizes), widest).copy()
    else:
        x = np.zeros((len(sizes), widest))
        x[np.arange(widest) < sizes[:, None]] = flat
    x /= np.abs(x).max(axis=1, keepdims=True, initial=np.finfo(float).tiny)
    return x / np.linalg.norm(x, axis=1, keepdims=True), sizes


def sign_keys(x: np.ndarray, sizes: np.ndarray, turn: int) -> np.ndarray:
    """63 signs of projections on directions of this pass; directions of long vectors begin with those of short ones."""
    keys = np.zeros(len(x), np.int64)
    if len(x):
        directions = np.random.default_rng([20, turn]).standard_normal((x.shape[1], _BITS))
        bits = (x @ directions) > 0
        keys = bits.astype(np.int64) @ (1 << np.arange(_BITS - 1, -1, -1, dtype=np.int64))
    return keys


def window_links(x: np.ndarray, sizes: np.ndarray, place: np.ndarray, similarity: float, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows, sorted by ``place``, at most ``window`` places apart and similar enough."""
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for first in range(0, len(x), _STEP):
        last = min(first + _STEP, len(x))
        stop = int(np.searchsorted(place, place[last - 1] + window, "right"))
        i, j = np.nonzero(x[first:last] @ x[first:stop].T >= similarity)
        i, j = i + first, j + first
        keep = (j > i) & (place[j] - place[i] <= window) & (sizes[i] == sizes[j])
        left.append(i[keep])
        right.append(j[keep])
    return np.concatenate(left), np.concatenate(right)


def joined_rows(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Each row's least row reachable by links i - j."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[i], label[j])
        after = label.copy()
        np.minimum.at(after, i, least)
        np.minimum.at(after, j, least)
        after = after[after]
        if (after == label).all():
            return label
        label = after


def _edges(node: np.ndarray, x: np.ndarray, sizes: np.ndarray, place: np.ndarray, similarity: float, window: int):
    label = joined_rows(len(x), *window_links(x, sizes, place, similarity, window))
    moved = np.flatnonzero(label != np.arange(len(x)))
    return node[moved], node[label[moved]]


def _pass(nodes: DataFrame, turn: int, kind: str, similarity: float, window: int) -> DataFrame:
    """``a, b``: links of one sorted pass, one per node at most for each of task and seam.

    Nodes are sorted in ranges. A task compares its own; the first and last ``window`` of it
    also go to the seams, where they meet those of the ranges around by their place in
    the whole order. Ranges shorter than a window go there whole.
    """

    def key(vectors: pa.Array) -> pa.Array:
        return pa.array(sign_keys(*unit_rows(vectors), turn))

    key.__annotations__ = {"vectors": pa.Array, "return": pa.Array}
    keyed = nodes.select("node", "v", F.size("v").alias("size"), F.arrow_udf(key, "long")("v").alias("key"))
    # The node's hash splits a crowd that has one key.
    order = ["size", "key", F.xxhash64("node")]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("node", "v")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen, held = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            before = held.num_rows if held is not None else 0
            own = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, own]).combine_chunks() if before else own
            node = table.column(0).to_numpy()
            x, sizes = unit_rows(table.column(1).combine_chunks())
            a, b = _edges(node, x, sizes, np.arange(len(node)), similarity, window)
            yield rows(len(a), a=a, b=b)
            if seen < window:
                head = own.slice(0, window - seen)
                yield rows(head.num_rows, a=head.column(0), v=head.column(1), part=part, at=np.arange(seen, seen + head.num_rows))
            seen += batch.num_rows
            held = table.slice(max(table.num_rows - window, 0))
        if held is not None:
            # What went out as head does not go out again as tail.
            tail = held.slice(max(0, held.num_rows - max(seen - window, 0)))
            at = np.arange(seen - tail.num_rows, seen)
            yield rows(tail.num_rows, a=tail.column(0), v=tail.column(1), part=part, at=at)
            yield rows(1, part=part, count=[seen])

    schema = pa.schema([
        ("a", pa.int64()), ("b", pa.int64()), ("v", pa.list_(_ARROW[kind])), ("part", pa.int64()), ("at", pa.int64()),
        ("count", pa.int64()),
    ])

    def rows(n: int, **columns) -> pa.RecordBatch:
        def column(field: pa.Field) -> pa.Array:
            value = columns.get(field.name)
            if value is None:
                return pa.nulls(n, field.type)
            if isinstance(value, int):
                return pa.array(np.full(n, value), field.type)
            if isinstance(value, pa.ChunkedArray):
                return value.combine_chunks().cast(field.type)
            return pa.array(value, field.type)

        return pa.record_batch([column(f) for f in schema], schema=schema)

    found = staged(ranged.mapInArrow(compare, f"a long, b long, v array<{kind}>, part long, at long, count long"))
    links = found.filter("b IS NOT NULL").select("a", "b")
    # One count per task, so few that the driver adds them up.
    counts = sorted(found.filter("count IS NOT NULL").select("part", "count").collect())
    if len(counts) < 2:
        return links
    starts = np.r_[0, np.cumsum([c["count"] for c in counts])[:-1]].tolist()
    shifts = nodes.sparkSession.createDataFrame(
        [(c["part"], s) for c, s in zip(counts, starts, strict=True)], "of_part long, shift long"
    )
    placed = found.filter("at IS NOT NULL").join(F.broadcast(shifts), F.col("part") == F.col("of_part"))
    place = (F.col("shift") + F.col("at")).alias("place")
    placed = placed.select(F.col("a").alias("node"), "v", place)
    seam = F.floor(F.col("place") / _SEAM)
    early = F.col("place") % _SEAM < window
    placed = placed.withColumn("seam", F.explode(F.when(early, F.array(seam - 1, seam)).otherwise(F.array(seam))))

    def meet(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        x, sizes = unit_rows(table.column("v").combine_chunks())
        place = table.column("place").to_numpy()
        a, b = _edges(table.column("node").to_numpy(), x, sizes, place, similarity, window)
        return pa.table({"a": a, "b": b})

    return links.union(placed.groupBy("seam").applyInArrow(meet, "a long, b long"))


_ARROW = {"float": pa.float32(), "double": pa.float64()}


def _valid(v: Column) -> Column:
    """Whether a vector can be compared: no null or non-finite component, and not all zeros."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _small_counts(members: DataFrame, similarity: float) -> DataFrame:
    """``node, links``: linked copies of other nodes, for components of bounded size."""

    def count(table: pa.Table) -> pa.Table:
        x, sizes = unit_rows(table.column("v").combine_chunks())
        copies = table.column("copies").to_numpy()
        linked = (x @ x.T >= similarity) & (sizes[:, None] == sizes[None, :])
        np.fill_diagonal(linked, False)
        return pa.table({"node": table.column("node"), "links": pa.array(linked @ copies)})

    return members.groupBy("component").applyInArrow(count, "node long, links long")


def _large_counts(members: DataFrame, sizes: DataFrame, similarity: float, block: int) -> DataFrame:
    """``node, links`` for components of any size: by the mean direction, else block against block."""

    def scaled(vectors: pa.Array) -> pa.Array:
        x, _ = unit_rows(vectors)
        return pa.array(list(x), pa.list_(pa.float64()))

    scaled.__annotations__ = {"vectors": pa.Array, "return": pa.Array}
    half = math.acos(similarity) / 2 - _SLACK
    # Each member has one of the component's blocks, so that no component is one key.
    blocks = sizes.select("component", F.explode(F.sequence(F.lit(0), F.floor(F.col("members") / block))).alias("block"), "members")
    own = F.pmod(F.xxhash64("node"), F.floor(F.col("members") / block) + 1)
    dealt = staged(
        members.withColumn("block", own).drop("members")
        .withColumn("u", F.arrow_udf(scaled, "array<double>")("v"))
        .select("component", "block", "node", "copies", "u")
    )
    # Vectors of one component have one length, as others are never linked.
    means = dealt.groupBy("component").agg(vector_to_array(Summarizer.mean(array_to_vector("u"))).alias("mean"))
    means = staged(blocks.select("component", "block").join(means, "component"))

    def angle(one: pa.Array, other: pa.Array) -> pa.Array:
        (x, _), (y, _) = unit_rows(one), unit_rows(other)
        return pa.array(np.arccos(np.clip((x * y).sum(axis=1), -1, 1)))

    angle.__annotations__ = {"one": pa.Array, "other": pa.Array, "return": pa.Array}
    has_mean = F.exists("mean", lambda m: F.abs(m) > _SLACK)
    off = F.when(has_mean, F.arrow_udf(angle, "double")("u", F.when(has_mean, F.col("mean")).otherwise(F.col("u"))))
    central = F.coalesce(off < half, F.lit(False)).alias("central")
    marked = staged(dealt.join(means, ["component", "block"]).select("component", "block", "node", "copies", "u", central))

    per_component = marked.groupBy("component").agg(
        F.sum(F.when(F.col("central"), F.col("copies"))).alias("central_copies"), F.count_if(~F.col("central")).alias("outer")
    )
    per_block = staged(blocks.select("component", "block").join(per_component, "component"))
    marked = marked.join(per_block, ["component", "block"])
    certain = marked.filter("central").select("node", (F.col("central_copies") - F.col("copies")).alias("links"))

    inner = staged(_packed(marked, "block"))
    shift = F.pmod(F.xxhash64("node", F.lit(1)), F.floor(F.col("outer") / block) + 1)
    outer = _packed(marked.filter("NOT central").withColumn("block", shift), "block")
    outer = staged(outer.select("component", *[F.col(c).alias(f"outer_{c}") for c in ("nodes", "copies", "units")]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                read = lambda c, kind: np.frombuffer(batch.column(c)[i].as_py(), kind)  # noqa: E731, B023
                some, others, central = read("outer_nodes", np.int64), read("nodes", np.int64), read("central", bool)
                linked = read("outer_units", np.float64).reshape(len(some), -1) @ (
                    read("units", np.float64).reshape(len(others), -1).T
                ) >= similarity
                linked &= some[:, None] != others[None, :]
                yield _links(some, linked @ read("copies", np.int64))
                # Outer nodes among the others count their links in their own turn.
                yield _links(others[central], linked.T[central] @ read("outer_copies", np.int64))

    compared = outer.join(inner, "component").drop("component").mapInArrow(count, "node long, links long")
    return certain.union(compared)


def _links(node: np.ndarray, links: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch({"node": pa.array(node, pa.int64()), "links": pa.array(links, pa.int64())})


def _packed(members: DataFrame, block: str) -> DataFrame:
    """One row per component and block: its nodes' columns one after the other, as bytes."""

    def packed(table: pa.Table) -> pa.Table:
        units = np.stack(table.column("u").combine_chunks().to_numpy(zero_copy_only=False))
        of = lambda c: table.column(c).to_numpy().tobytes()
        return pa.table({
            "component": table.column("component").slice(0, 1), "nodes": pa.array([of("node")]),
            "copies": pa.array([of("copies")]), "central": pa.array([of("central")]), "units": pa.array([units.tobytes()]),
        })

    columns = "component long, nodes binary, copies binary, central binary, units binary"
    return members.select("component", block, "node", "copies", "central", "u").groupBy("component", block).applyInArrow(
        packed, columns
    )


def near_duplicate_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", similarity: float = SIMILARITY,
    window: int = WINDOW, missed: float = MISSED, block: int = BLOCK, passes: int | None = None,
) -> DataFrame:
    """``<id>, n_links, component_id`` for each row of ``vectors``.

    Two rows are linked when the cosine of their vectors in double precision is at least
    ``similarity``; ``n_links`` counts the other rows linked directly, equal vectors included, and
    ``component_id`` is the least id that links lead to. No link below ``similarity`` counts. A
    component may be missed as ``missed`` says; within the components found, no link is.
    ``passes`` replaces the number that follows from the rows.

    A vector that is null, empty, all zeros or holds a null or non-finite component is linked
    with nothing, and vectors of different lengths are not linked: 0 links, the own id. Repeated
    rows, with one id too, are rows of their own, linked by equal vectors. Rows of a null id are
    counted like others; their component has the least id of the others, or null. Other columns
    are not read; an empty table gives no rows.
    """
    v = F.col(vector_column)
    kind = vectors.schema[vector_column].dataType.elementType.simpleString()
    if kind not in _ARROW:
        v, kind = v.cast("array<double>"), "double"
    given = vectors.select(F.col(id_column).alias("id"), v.alias("v"))
    valid = _valid(F.col("v"))
    good = given.filter(valid)
    nodes = staged(
        good.groupBy("v").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    turns = passes or passes_needed(nodes.count(), similarity, window, missed)
    edges = reduce(DataFrame.union, [_pass(nodes.select("node", "v"), i, kind, similarity, window) for i in range(turns)])
    labels = connected_components(edges).select("node", F.col("label").alias("component"))

    members = staged(nodes.join(labels, "node"))
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    large = staged(sizes.filter(F.col("members") > block))
    sized = members.select("component", "node", "copies", "v").join(large, "component", "left")
    links = _small_counts(sized.filter("members IS NULL").drop("members"), similarity)
    if not large.isEmpty():
        links = links.union(_large_counts(sized.filter("members IS NOT NULL"), large, similarity, block))
    links = links.groupBy("node").agg(F.sum("links").alias("links"))
    least = members.groupBy("component").agg(F.min("least").alias("component_id"))
    found = members.select("node", "component").join(least, "component").join(links, "node", "left")
    scored = staged(
        nodes.join(found.select("node", "component_id", "links"), "node", "left").select(
            F.col("v").alias("of_v"), F.coalesce("component_id", "least").alias("component_id"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        )
    )
    compared = good.join(scored, F.col("v") == F.col("of_v")).select("id", "n_links", "component_id")
    alone = given.filter(~valid).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return compared.union(alone).withColumnRenamed("id", id_column)
