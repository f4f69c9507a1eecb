"""Best-fit packing of tokenised documents into sequences.

Documents are tokenised where they are read; only the pieces' lengths travel. The
pieces are dealt by their place into shards of about ``shard_pieces``, so a very long
document or a hot source is spread like the rest, and each shard is packed by
best-fit decreasing: pieces from long to short, each into the tightest open
sequence, found in a segment tree over remaining capacities. A shard leaves about one
sequence part-filled, which is what is lost against one packing of everything.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapledger.llm.bpe import load_core, load_tokenizer
from gapledger.llm.staging import staged
from gapledger.llm.text import free_name
from gapledger.llm.workers import worker_memo

CAPACITY = 2048
SHARD_PIECES = 20_000
#: Characters whose classes do not depend on a Unicode version; others go to ``tokenizers``.
_SETTLED = re.compile("[\t\n\r -~\u00a1-\u024f]*")
_SHARD_BITS = 32

PIECES = "piece int, start long, length long, ids_crc32 long"


class BytePairIds:
    """Ids of whole texts as bytes (little-endian, 32 bits), as ``tokenizers`` gives them."""

    def __init__(self, path: str) -> None:
        self.tokenizer, self.core = load_tokenizer(path), load_core(path)

    def ids(self, text: str) -> bytes:
        if "<|" in text or not (text.isascii() or _SETTLED.fullmatch(text)):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return np.frombuffer(self.core.encode_to_tiktoken_buffer(text, set()), "<u4").tobytes()


def cut(n_tokens: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of each piece; all but the first are full."""
    first = n_tokens % capacity or capacity
    starts = [0, *range(first, n_tokens, capacity)]
    return [(s, e - s) for s, e in zip(starts, [*starts[1:], n_tokens], strict=True)]


def token_pieces(
    docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text",
    end_id: int = 0, capacity: int = CAPACITY,
) -> DataFrame:
    """``<id>, piece, start, length, ids_crc32``: each whole text's ids and ``end_id``, cut to ``capacity``.

    A null text is empty and so has one piece with the closing id alone.
    """
    close = np.array([end_id], "<u4").tobytes()

    def tokenise(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = worker_memo(("byte_pair_ids", tokenizer_path), lambda: BytePairIds(tokenizer_path))
        for texts in batches:
            rows = []
            for text in texts:
                ids = encoder.ids(text.as_py() or "") + close
                rows.append([
                    {"piece": i, "start": s, "length": n, "ids_crc32": zlib.crc32(ids[4 * s : 4 * (s + n)])}
                    for i, (s, n) in enumerate(cut(len(ids) // 4, capacity))
                ])
            yield pa.array(rows, pa.list_(pa.struct([
                ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
            ])))

    tokenise.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    pieces = F.arrow_udf(tokenise, f"array<struct<{PIECES.replace(' ', ':').replace(',:', ',')}>>").asNondeterministic()
    rows = docs.select(F.col(id_column).alias("_id"), pieces(F.col(text_column).cast("string")).alias("_pieces"))
    return rows.select("_id", F.inline("_pieces")).withColumnRenamed("_id", id_column)


class OpenSequences:
    """Segment tree over remaining capacities: which of them some open sequence has."""

    def __init__(self, capacity: int) -> None:
        self.size = 1
        while self.size <= capacity:
            self.size *= 2
        self.most = [-1] * (2 * self.size)  # largest capacity present below each node
        self.open: list[list[int]] = [[] for _ in range(self.size)]

    def _set(self, capacity: int, present: bool) -> None:
        node = self.size + capacity
        self.most[node] = capacity if present else -1
        while node > 1:
            node //= 2
            self.most[node] = max(self.most[2 * node], self.most[2 * node + 1])

    def add(self, capacity: int, sequence: int) -> None:
        self.open[capacity].append(sequence)
        if len(self.open[capacity]) == 1:
            self._set(capacity, True)

    def take_tightest(self, needed: int) -> tuple[int, int] | None:
        """(capacity, sequence) of the open sequence with the least capacity of at least ``needed``."""
        node = self.size + needed
        if self.most[node] < 0:
            while node > 1 and not (node % 2 == 0 and self.most[node + 1] >= 0):
                node //= 2
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.most[2 * node] >= 0 else 2 * node + 1
        capacity = node - self.size
        sequence = self.open[capacity].pop()
        if not self.open[capacity]:
            self._set(capacity, False)
        return capacity, sequence


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length; sequences are numbered from 0."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, used = OpenSequences(capacity), 0
    for i in np.argsort(-lengths, kind="stable"):
        need = int(lengths[i])
        if found := tree.take_tightest(need):
            left, sequence[i] = found
        else:
            left, sequence[i], used = capacity, used, used + 1
        offset[i] = capacity - left
        if left > need:
            tree.add(left - need, int(sequence[i]))
    return sequence, offset


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; sequences are gapless from 0.

    ``length`` is 1 to ``capacity``. Rows are told apart by nothing but their place, so
    repeated ones are packed each. An empty table gives an empty one.
    """
    place = free_name(pieces, "_place")
    placed = staged(pieces.withColumn(place, F.monotonically_increasing_id()))
    shards = max(1, -(-placed.count() // shard_pieces))
    # By place, so that rows that are the same in all columns are spread like others.
    dealt = placed.withColumn("_shard", F.pmod(F.xxhash64(place), F.lit(shards)))

    def pack_shard(table: pa.Table) -> pa.Table:
        sequence, offset = best_fit_decreasing(table["length"].to_numpy(), capacity)
        shard = table["_shard"].to_numpy().astype(np.int64) << _SHARD_BITS
        table = table.drop_columns(["_shard", place])
        return table.append_column("sequence_id", pa.array(shard | sequence)).append_column("offset", pa.array(offset))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.groupBy("_shard").applyInArrow(pack_shard, f"{fields}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text",
    end_id: int = 0, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """``<id>, piece, start, length, ids_crc32, sequence_id, offset`` of all ``docs``.

    Null ids stay null; repeated rows are packed each; other columns are not read.
    """
    return pack(token_pieces(docs, tokenizer_path, id_column, text_column, end_id, capacity), capacity, shard_pieces)
