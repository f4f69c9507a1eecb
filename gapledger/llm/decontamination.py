"""Passages of benchmark items inside documents: SimHash windows, then exact similarity.

An item of m words is compared with windows of m words. A window without a shingle in
common with an item has similarity 0, so fingerprints are made only of the windows that
hold a shingle of an item of their size. A 128-bit SimHash of a window's shingles, each
as often as it occurs, is looked up in an index of the items' fingerprints: these are
cut into ``radius + 1`` blocks, and of two fingerprints within the radius at least one
block is equal, so no item within the radius is missed. What the index returns is
compared by weighted Jaccard similarity of the shingles.

At a similarity of 0.8 the fingerprints differ in 19 bits on average; beyond the radius
of 31 are about one in 700 of the pairs that are just similar enough.

Items are a stated query set. They are read in blocks of ``block_items``, so what
travels to the tasks is bounded; documents are read once for each block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapledger.llm.shingles import WORDS, WordReader, as_set, jaccard, mix, shingles
from gapledger.llm.text import free_name

SIMILARITY = 0.8
RADIUS = 31
BITS = 128
BLOCK_ITEMS = 5_000
_SECOND = np.uint64(0xA0761D6478BD642F)


def _bits(values: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of a shingle's bits."""
    words = np.stack([mix(values), mix(values ^ _SECOND)], 1)
    return np.unpackbits(words.view(np.uint8), axis=1).astype(np.int8) * 2 - 1


def fingerprints(values: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """SimHash, as packed bytes, of the ``width`` shingles from each of ``starts`` on."""
    sums = np.zeros((len(values) + 1, BITS), np.int32)
    np.cumsum(_bits(values), axis=0, out=sums[1:])
    return np.packbits(sums[starts + width] - sums[starts] > 0, axis=1)


class HammingIndex:
    """Fingerprints by the value of each of ``radius + 1`` blocks of bits."""

    def __init__(self, prints: np.ndarray, radius: int = RADIUS) -> None:
        self.prints, self.radius = prints, radius
        bits = np.unpackbits(prints, axis=1)
        self.blocks = np.array_split(np.arange(BITS), radius + 1)
        self.tables = []
        for block in self.blocks:
            table: dict[bytes, list[int]] = {}
            for i, row in enumerate(bits[:, block]):
                table.setdefault(row.tobytes(), []).append(i)
            self.tables.append({k: np.array(v) for k, v in table.items()})

    def near(self, print_: np.ndarray) -> np.ndarray:
        """All fingerprints within the radius."""
        bits = np.unpackbits(print_)
        none = np.zeros(0, np.int64)
        found = [t.get(bits[b].tobytes(), none) for t, b in zip(self.tables, self.blocks, strict=True)]
        found = np.unique(np.concatenate(found)).astype(np.int64)
        distance = np.bitwise_count(self.prints[found] ^ print_).sum(1)
        return found[distance <= self.radius]


@dataclass
class Items:
    """A block of items, by number: words, multiset and shingles; which items hold a shingle."""

    ids: list
    words: list[int]
    sets: list[np.ndarray]
    index: HammingIndex
    anchors: dict[int, np.ndarray]  # shingle size: sorted hashes of shingles
    holders: dict[int, list[np.ndarray]]  # for each of these hashes, the items with it

    @classmethod
    def of(cls, rows: list[tuple], radius: int) -> Items | None:
        reader = WordReader()
        read = [(i, reader.words(text or "")) for i, text in rows]
        read = [(i, w) for i, w in read if len(w)]
        if not read:
            return None
        made = [shingles(w) for _, w in read]
        prints = np.concatenate([fingerprints(s, np.array([0]), len(s)) for s in made])
        holders: dict[int, dict[int, set]] = {}
        for n, ((_, w), values) in enumerate(zip(read, made, strict=True)):
            for value in values.tolist():
                holders.setdefault(min(WORDS, len(w)), {}).setdefault(value, set()).add(n)
        anchors = {k: np.array(sorted(v), np.uint64) for k, v in holders.items()}
        return cls(
            [i for i, _ in read], [len(w) for _, w in read], [as_set(s) for s in made], HammingIndex(prints, radius),
            anchors, {k: [np.array(sorted(holders[k][x])) for x in v.tolist()] for k, v in anchors.items()},
        )


def _window_starts(anchored: np.ndarray, width: int, count: int) -> np.ndarray:
    """Starts of the windows of ``width`` shingles, of ``count`` shingles in all, that hold one of ``anchored``."""
    edges = np.zeros(count + 1, np.int64)
    np.add.at(edges, np.maximum(anchored - width + 1, 0), 1)
    np.add.at(edges, anchored + 1, -1)
    return np.flatnonzero(np.cumsum(edges[: max(count - width + 1, 0)]) > 0)


def find_items(words: np.ndarray, items: Items, similarity: float) -> dict[int, float]:
    """Number of each item in a document of these words: its best similarity."""
    best: dict[int, float] = {}
    for size, anchors in items.anchors.items():
        if len(words) < size:
            continue
        values = shingles(words, size)
        at = np.minimum(np.searchsorted(anchors, values), len(anchors) - 1)
        hits = np.flatnonzero(anchors[at] == values)
        if not len(hits):
            continue
        by_width: dict[int, list[int]] = {}
        for place in hits.tolist():
            for n in items.holders[size][at[place]].tolist():
                by_width.setdefault(items.words[n] - size + 1, []).append(place)
        for width, places in by_width.items():
            # A document shorter than the item is one window.
            width = min(width, len(values))
            places = np.unique(places)
            # Far apart places are read apart, so that a long document costs what its passages do.
            for run in np.split(places, np.flatnonzero(np.diff(places) > 2 * width) + 1):
                low, high = max(run[0] - width + 1, 0), min(run[-1] + width, len(values))
                near = values[low:high]
                starts = _window_starts(run - low, width, len(near))
                sets: dict[int, np.ndarray] = {}
                for start, print_ in zip(starts.tolist(), fingerprints(near, starts, width), strict=True):
                    for n in items.index.near(print_).tolist():
                        # An item is sought in windows of its own width alone, whatever else is near.
                        if min(WORDS, items.words[n]) != size or min(items.words[n] - size + 1, len(values)) != width:
                            continue
                        if start not in sets:
                            sets[start] = as_set(near[start : start + width])
                        if (s := jaccard(sets[start], items.sets[n])) >= similarity:
                            best[n] = max(best.get(n, 0.0), s)
    return best


_FOUND = pa.list_(pa.struct([("item", pa.int64()), ("similarity", pa.float64())]))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text_column: str = "text", similarity: float = SIMILARITY,
    radius: int = RADIUS, block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """``docs`` with ``contaminated``, ``item_ids`` (sorted) and ``best_similarity`` (0 without an item).

    An item is in a document if some window of as many words has a weighted Jaccard
    similarity of at least ``similarity`` to it, over five-word shingles; for items of
    fewer words, over the item as a whole. Documents and items without words match
    nothing, items with a null id are not sought. Columns of ``docs`` with the names of
    the new ones give way; repeated rows and empty tables stay as they are.
    """
    sought = benchmark.select(
        F.col(item_column).cast("long").alias("id"), F.col(item_text_column).cast("string").alias("text")
    ).filter("id IS NOT NULL")
    blocks = max(1, -(-sought.count() // block_items))
    added = ("contaminated", "item_ids", "best_similarity")
    names = [free_name(docs, f"_found{b}") for b in range(blocks)]
    rows = docs
    for b, name in enumerate(names):
        part = sought.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b) if blocks > 1 else sought
        items = Items.of([(r["id"], r["text"]) for r in part.orderBy("id", "text").collect()], radius)
        rows = rows.withColumn(name, _finder(docs, items, similarity)(F.col(text_column).cast("string")))
    every = F.flatten(F.array(*names))
    ids = F.array_sort(F.array_distinct(F.transform(every, lambda x: x["item"])))
    best = F.coalesce(F.array_max(F.transform(every, lambda x: x["similarity"])), F.lit(0.0))
    return rows.select(
        *[F.col(c) for c in docs.columns if c not in added],
        (F.size(every) > 0).alias("contaminated"), ids.alias("item_ids"), best.alias("best_similarity"),
    )


def _finder(docs: DataFrame, items: Items | None, similarity: float):
    sent = docs.sparkSession.sparkContext.broadcast(items)

    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader, items = WordReader(), sent.value
        for texts in batches:
            found = []
            for text in texts:
                best = find_items(reader.words(text.as_py() or ""), items, similarity) if items else {}
                found.append([{"item": items.ids[n], "similarity": s} for n, s in sorted(best.items())])
            yield pa.array(found, _FOUND)

    find.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(find, "array<struct<item:long,similarity:double>>").asNondeterministic()


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with the columns of ``docs``."""
    added = ("contaminated", "item_ids", "best_similarity")
    own = {c: free_name(docs, f"_own_{c}") for c in docs.columns if c in added}
    marked = contaminated(docs.withColumns({n: F.col(c) for c, n in own.items()}), benchmark, **options)
    return marked.filter("NOT contaminated").select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])
