"""Byte strings of at least ``length`` bytes that stand more than once, found in suffix order.

A string of 200 bytes holds 161 grams of 40 bytes; the one with the least hash, the
leftmost of equals, is its anchor. Equal strings have equal anchors at the same place,
so strings with different anchors never have to be compared. Of each anchor a document
keeps the run of string starts that have it, and a hash of the bytes these strings cover.

* An anchor that stands once anywhere has no repeated string.
* Runs with the same anchor and the same bytes repeat each other in full. They are
  counted by aggregation, so a passage in a third of all documents is one row per task.
* Of what is left, one run of each kind goes to a bucket by its anchor. A bucket's bytes
  are brought into suffix order, to the depth of ``length``; entries that agree so far
  stand together, earlier positions first. The previous smaller position of an entry is
  then its neighbour before, if that agrees: the longest-previous-factor test at this
  length. The neighbour after tells of a later copy.
* Anchors with very many kinds (the edge of a common passage) would fill one bucket;
  their strings are grouped by digest instead, which spreads them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapledger.llm.shingles import mix
from gapledger.llm.staging import staged
from gapledger.llm.workers import slices

LENGTH, GRAM = 200, 40
#: Runs in one bucket's task, about 300 bytes each.
BUCKET_RUNS = 8_000
#: An anchor with more kinds of runs than this is grouped by digest.
HOT_KINDS = 2_000
#: Runs of whole anchors that are brought into order at a time, within a bucket's task.
ORDERED_RUNS = 512
#: Characters or bytes that a task turns into rows at a time.
_SLICE = 1_000_000
_CHUNK = 1 << 23
_PLACE = np.uint64((1 << 24) - 1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class _Hasher:
    """Hashes of any stretch of bytes from prefix sums of byte values times powers of an odd base."""

    def __init__(self) -> None:
        self.values = mix(np.arange(1, 257, dtype=np.uint64))
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if len(self.powers) < size:
            size = max(size, 1 << 17)
            steps = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
            for s in steps:
                s[0] = 1
            self.powers, self.inverses = (np.multiply.accumulate(s) for s in steps)

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.values[data] * self.powers[: len(data)])])

    def stretch(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self.inverses[start])


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` values, by running minima within blocks from both sides."""
    count = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:count], ahead[width - 1 : width - 1 + count])


def anchor_runs(data: np.ndarray, hasher: _Hasher, length: int = LENGTH, gram: int = GRAM):
    """(anchor hash, covered bytes' hash, first start, last start) of each run of string starts."""
    found = []
    for base in range(0, max(1, len(data) - length + 1), _CHUNK):
        part = data[base : base + _CHUNK + length - 1]
        if len(part) < length:
            continue
        sums = hasher.sums(part)
        at = np.arange(len(part) - gram + 1)
        grams = hasher.stretch(sums, at, at + gram)
        least = _sliding_least((grams & ~_PLACE) | at.astype(np.uint64), length - gram + 1)
        place = (least & _PLACE).astype(np.int64)
        low = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        high = np.r_[low[1:] - 1, len(place) - 1]
        anchor = place[low]
        shape = ((anchor - low) << 32 | (high - low)).astype(np.uint64)
        covered = mix(hasher.stretch(sums, low, high + length) ^ mix(shape))
        found.append((grams[anchor], covered, low + base, high + base))
    empty = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else empty


def ordered_to_depth(data: np.ndarray, length: int) -> np.ndarray:
    """For each position, the rank of its suffix among all, compared over ``length`` (at least 8) bytes."""
    size = len(data)
    padded = np.concatenate([data, np.zeros(length + 8, np.uint8)]).astype(np.uint64)
    key = np.zeros(size, np.uint64)
    for j in range(8):
        key = key << np.uint64(8) | padded[j : j + size]
    rank, depth = np.unique(key, return_inverse=True)[1].astype(np.uint64), 8
    while depth < length:
        step = min(depth, length - depth)
        further = np.concatenate([rank[step:], np.zeros(step, np.uint64)])
        rank = np.unique(rank << np.uint64(32) | further, return_inverse=True)[1].astype(np.uint64)
        depth += step
    return rank.astype(np.int64)


def factors(runs: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each string start of all runs: run, offset, and if an earlier and a later start has the same string."""
    sizes = np.array([len(r) for r in runs])
    counts = np.maximum(sizes - length + 1, 0)
    run = np.repeat(np.arange(len(runs)), counts)
    offset = np.arange(len(run)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = np.repeat(np.cumsum(sizes) - sizes, counts) + offset
    rank = ordered_to_depth(np.frombuffer(b"".join(runs), np.uint8), length)[starts]
    order = np.argsort(rank, kind="stable")  # equal ones stay by position
    same = rank[order][1:] == rank[order][:-1]
    earlier, later = np.zeros(len(run), bool), np.zeros(len(run), bool)
    earlier[order[1:]] = same
    later[order[:-1]] = same
    return run, offset, earlier, later


def _stretches(marked: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.r_[False, marked, False].astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


_RUNS = "array<struct<a:long,c:long,low:int,high:int>>"


def _lists(counts: list[int], values: pa.Array) -> pa.Array:
    """``values`` as lists of so many each."""
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), values)


def _anchors(texts: DataFrame, length: int) -> DataFrame:
    """``id, h, n_bytes, sha, runs`` of each text."""
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hasher = _Hasher()
        for batch in batches:
            for part in slices(batch, _SLICE):
                n_bytes, sha, found = [], [], []
                for text in part:
                    data = text.encode("utf-8", "surrogatepass")
                    n_bytes.append(len(data))
                    sha.append(hashlib.sha256(data).hexdigest())
                    found.append(anchor_runs(np.frombuffer(data, np.uint8), hasher, length))
                a, c, low, high = (np.concatenate(x) for x in zip(*found, strict=True))
                columns = a.view(np.int64), c.view(np.int64), low.astype(np.int32), high.astype(np.int32)
                runs = pa.StructArray.from_arrays([pa.array(x) for x in columns], ["a", "c", "low", "high"])
                listed = _lists([len(x[0]) for x in found], runs)
                yield pa.StructArray.from_arrays(
                    [pa.array(n_bytes, pa.int64()), pa.array(sha, pa.string()), listed], ["n_bytes", "sha", "runs"]
                )

    find.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    made = F.arrow_udf(find, f"struct<n_bytes:long,sha:string,runs:{_RUNS}>").asNondeterministic()
    return texts.select("id", "h", made(F.col("text")).alias("f")).select("id", "h", "f.*")


def _run_bytes(texts: DataFrame, length: int) -> DataFrame:
    """One row for each of ``runs``, with its ``bytes``."""
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, runs in batches:
            flat = runs.flatten()
            low, high = flat.field("low").to_numpy(), flat.field("high").to_numpy()
            own = pc.fill_null(pc.list_value_length(runs), 0).to_numpy()
            ends = np.cumsum(own)
            counts, found, size = [], [], 0
            for t, count, end in zip(text, own.tolist(), ends.tolist(), strict=True):
                data = (t.as_py() or "").encode("utf-8", "surrogatepass") if count else b""
                spans = zip(low[end - count : end].tolist(), high[end - count : end].tolist(), strict=True)
                found += [data[x : y + length] for x, y in spans]
                counts.append(count)
                size += sum(map(len, found[len(found) - count :]))
                if size > _SLICE:
                    yield _lists(counts, pa.array(found, pa.binary()))
                    counts, found, size = [], [], 0
            if counts:
                yield _lists(counts, pa.array(found, pa.binary()))

    cut.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    pieces = F.arrow_udf(cut, "array<binary>").asNondeterministic()("text", "runs")
    rows = texts.select("id", "h", "runs", pieces.alias("pieces"))
    return rows.select("id", "h", F.inline(F.arrays_zip("runs", "pieces"))).select("id", "h", "runs.*", F.col("pieces").alias("bytes"))


def anchor_portions(anchor: np.ndarray, runs: int = ORDERED_RUNS) -> list[tuple[int, int]]:
    """Sorted anchors cut into stretches of about ``runs``, all of an anchor in one: other strings never agree."""
    begins = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1], True])
    cuts = [0]
    while cuts[-1] < len(anchor):
        cuts.append(int(begins[np.searchsorted(begins, min(cuts[-1] + runs, len(anchor)))]))
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def _bucket_spans(runs: DataFrame, buckets: int, keep_first: bool, length: int) -> DataFrame:
    def order(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("a", "id", "h", "low")])
        low, anchor = table["low"].to_numpy(), table["a"].to_numpy()
        rows, starts, ends = [], [], []
        for first, stop in anchor_portions(anchor):
            run, offset, earlier, later = factors(table["bytes"].slice(first, stop - first).to_pylist(), length)
            hit = earlier if keep_first else earlier | later
            bounds = np.searchsorted(run, np.arange(stop - first + 1))
            for i in np.unique(run[hit]).tolist():
                for s, e in _stretches(hit[bounds[i] : bounds[i + 1]]):
                    rows.append(first + i)
                    starts.append(int(low[first + i]) + s)
                    ends.append(int(low[first + i]) + e - 1 + length)
        taken = table.select(["id", "h"]).take(pa.array(rows, pa.int64()))
        return taken.append_column("start", pa.array(starts, pa.int64())).append_column("end", pa.array(ends, pa.int64()))

    dealt = runs.withColumn("_bucket", F.pmod("a", F.lit(buckets)))
    kind = runs.schema["id"].dataType.simpleString()
    return dealt.groupBy("_bucket").applyInArrow(order, f"id {kind}, h long, start long, end long")


def _hot_spans(runs: DataFrame, keep_first: bool, length: int) -> DataFrame:
    def digests(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import xxhash

        for batch in batches:
            for k in range(0, len(batch), ORDERED_RUNS):
                yield pa.array([
                    [xxhash.xxh3_128_digest(data[i : i + length]) for i in range(len(data) - length + 1)]
                    for data in batch.slice(k, ORDERED_RUNS).to_pylist()
                ], pa.list_(pa.binary()))

    digests.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    made = F.arrow_udf(digests, "array<binary>").asNondeterministic()("bytes")
    strings = runs.select("id", "h", "low", F.posexplode(made).alias("offset", "digest"))
    strings = staged(strings.select("id", "h", (F.col("low") + F.col("offset")).cast("long").alias("start"), "digest"))
    place = F.struct("id", "h", "start")
    shared = strings.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).filter("n > 1")
    hit = strings.join(shared, "digest")
    if keep_first:
        hit = hit.filter(~place.eqNullSafe(F.col("first")))
    return hit.select("id", "h", "start", (F.col("start") + length).alias("end"))


_CUT = pa.struct([
    ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("sha", pa.string()),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
])


def _cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for text, spans in batches:
        rows, size = [], 0
        for t, of in zip(text, spans, strict=True):
            data = (t.as_py() or "").encode("utf-8", "surrogatepass")
            edges = np.zeros(len(data) + 1, np.int32)
            for s in of.as_py() or []:
                edges[s["start"]] += 1
                edges[s["end"]] -= 1
            gone = np.cumsum(edges[: len(data)]) > 0
            merged = _stretches(gone)
            kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
            rows.append({
                "n_removed": int(gone.sum()), "n_spans": len(merged), "sha": hashlib.sha256(kept).hexdigest(),
                "spans": [{"start": s, "end": e} for s, e in merged],
            })
            size += len(data)
            if size > _SLICE:
                yield pa.array(rows, _CUT)
                rows, size = [], 0
        if rows:
            yield pa.array(rows, _CUT)


_cut.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}


def repeated_strings(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH,
    keep_first: bool = True, bucket_runs: int = BUCKET_RUNS, hot_kinds: int = HOT_KINDS,
) -> DataFrame:
    """``<id>, n_bytes, n_removed, n_spans, kept_sha256, spans`` for each row of ``docs``.

    ``spans`` are the maximal runs of UTF-8 bytes covered by a string of ``length`` bytes
    (at least 64) that also starts elsewhere, in this or another document; with
    ``keep_first``, that also starts earlier, documents by id and then by hash of the
    text. Strings are judged on the input. A null text is empty; shorter texts have no
    span; rows that repeat id and text repeat each other, and with ``keep_first`` count
    as one. Null ids come first. Other columns are not read.
    """
    texts = docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")
    ).withColumn("h", F.crc32(F.col("text").cast("binary")))
    whole = staged(_anchors(texts, length))
    runs = whole.select("id", "h", F.inline("runs"))
    often = runs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a")
    runs = staged(runs.join(often, "a"))
    place = F.struct("id", "h", "low", "high")
    kinds = staged(runs.groupBy("a", "c").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")))
    of_anchor = kinds.groupBy("a").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")

    twice = kinds.filter("n > 1").select("a", "c", "first")
    full = runs.join(twice, ["a", "c"])
    if keep_first:
        full = full.filter(~place.eqNullSafe(F.col("first")))
    end = (F.col("high") + length).cast("long").alias("end")
    full = full.select("id", "h", F.col("low").cast("long").alias("start"), end)
    # As sets: rows that repeat id and text have the same spans, which each of them gets once.
    full = full.groupBy("id", "h").agg(F.collect_set(F.struct("start", "end")).alias("full"))
    single = kinds.join(of_anchor, "a").select(
        "first.id", "first.h", F.struct("a", "c", "first.low", "first.high").alias("run"), "kinds"
    )
    single = single.groupBy("id", "h").agg(F.collect_list(F.struct("run", "kinds")).alias("runs"))
    same = lambda x, y: x["id"].eqNullSafe(y["id"]) & (x["h"] == y["h"])
    listed = full.join(single, same(full, single), "full").select(
        F.coalesce(full["id"], single["id"]).alias("id"), F.coalesce(full["h"], single["h"]).alias("h"), "full", "runs"
    )
    named = listed.select(F.col("id").alias("of"), F.col("h").alias("of_h"), "full", "runs")
    touched = staged(
        texts.join(named, F.col("id").eqNullSafe(F.col("of")) & (F.col("h") == F.col("of_h"))).drop("of", "of_h")
    )

    pick = lambda hot: F.transform(
        F.filter("runs", lambda r: (r["kinds"] > hot_kinds) == F.lit(hot)), lambda r: r["run"]
    )
    once = touched.dropDuplicates(["id", "h"]) if keep_first else touched
    once = once.select("id", "h", "text", "runs")
    few = _run_bytes(once.withColumn("runs", pick(False)), length)
    buckets = max(1, -(-kinds.count() // bucket_runs))
    spans = _bucket_spans(few, buckets, keep_first, length)
    if of_anchor.filter(F.col("kinds") > hot_kinds).limit(1).count():
        many = _run_bytes(once.withColumn("runs", pick(True)), length)
        spans = spans.union(_hot_spans(many, keep_first, length))
    spans = spans.groupBy(F.col("id").alias("of"), F.col("h").alias("of_h")).agg(
        F.collect_set(F.struct("start", "end")).alias("more")
    )
    marked = touched.join(spans, F.col("id").eqNullSafe(F.col("of")) & (F.col("h") == F.col("of_h")), "left")
    nothing = F.array().cast("array<struct<start:bigint,end:bigint>>")
    every = F.concat(F.coalesce("full", nothing), F.coalesce("more", nothing))
    done = marked.select("id", F.octet_length("text").cast("long").alias("n_bytes"),
                         F.arrow_udf(_cut, "struct<n_removed:long,n_spans:long,sha:string,"
                                           "spans:array<struct<start:long,end:long>>>")
                         .asNondeterministic()(F.col("text"), every).alias("r"))
    done = done.select(
        "id", "n_bytes", "r.n_removed", "r.n_spans", F.col("r.sha").alias("kept_sha256"), "r.spans"
    )
    rest = whole.join(named, F.col("id").eqNullSafe(F.col("of")) & (F.col("h") == F.col("of_h")), "left_anti")
    rest = rest.select(
        "id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.col("sha").alias("kept_sha256"), nothing.alias("spans"),
    )
    return done.union(rest).withColumnRenamed("id", id_column)
