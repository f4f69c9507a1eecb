"""Which tokens of two tokenizers cover the same bytes, over a whole corpus.

Each tokenizer gives an incidence matrix of its tokens and the bytes they cover, A and B,
in compressed rows. The row product A·Bᵀ has an entry for each pair of tokens that
share bytes: the overlap links. Offsets where tokens of both end cut the text into
groups; the product of the tokens' group incidences has the pairs that share a group.

Neither tokenizer merges over a blank that follows another character than a blank and
precedes one that is no white space (checked on the vocabularies), so a text is cut there and
equal segments are aligned once. A document is then a row of segment counts, and its
row product with the segments' links counts its pairs of ids. Documents are kept in
chunks of bounded size, each with a dictionary of its distinct pairs: corpus-wide
counts are summed from the dictionaries and come back to a chunk once per distinct pair.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapledger.llm.bpe import load_core, ranks_of
from gapledger.llm.csr import Csr, ranges
from gapledger.llm.staging import staged
from gapledger.llm.workers import slices, worker_memo

#: Characters after which a chunk of documents ends, and documents.
CHUNK_CHARACTERS, CHUNK_ROWS = 8_000_000, 20_000
#: Characters of segments a worker remembers between chunks, and aligns at a time.
_MEMORY, _STEP = 6_000_000, 1_000_000
_BLANK = "▁"
#: Characters whose classes do not depend on a Unicode version; others go to ``tokenizers``.
_SETTLED = re.compile("[\t\n\r -~¡-ɏ]*")
_CUT = re.compile(r"(?<! ) (?=\S)")
_IRREGULAR = re.compile(r" (?!\S)")


class BytePairs:
    """Ids by ``tokenizers``, special strings as plain text, and the bytes of each id."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.core, self.tokenizer = load_core(path), Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.bytes_of = {i: b for b, i in ranks_of(path).items()}

    def ids(self, text: str) -> list[int]:
        if "<|" in text or not (text.isascii() or _SETTLED.fullmatch(text)):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.core.encode_ordinary(text)


class Pieces:
    """Ids by ``sentencepiece`` and the bytes of each id."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(_BLANK in p.lstrip(_BLANK) for p in pieces):
            raise ValueError(f"{path}: a piece spans the blank between two words")
        self.bytes_of = {
            i: bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(_BLANK, " ").encode()
            for i, p in enumerate(pieces)
        }

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def segments(text: str) -> list[str]:
    """``text`` cut at the blanks that no token of either side spans, which are left out."""
    if not text[0].isspace() and not _IRREGULAR.search(text):
        return text.split(" ")
    first, *others = _CUT.split(" " + text)
    return [first[1:], *others] if first else others


class Alignments:
    """Segments met so far, by number: tokens, groups, and links in compressed rows of pair numbers."""

    def __init__(self, one_path: str, other_path: str) -> None:
        self.one, self.other = BytePairs(one_path), Pieces(other_path)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.text: list[bytes] = []
        self.sizes = np.zeros((0, 5), np.int64)
        self.whole = np.zeros(0, bool)
        self.starts, self.pairs, self.times = (np.zeros(n, np.int64) for n in (1, 0, 0))
        self.characters = 0

    def learn(self, found: list[str]) -> None:
        step: list[str] = []
        size = 0
        for segment in found:
            step.append(segment)
            size += len(segment)
            if size > _STEP:
                self._learn(step)
                step, size = [], 0
        if step:
            self._learn(step)

    def _learn(self, found: list[str]) -> None:
        raw = [b" " + s.encode() for s in found]
        a = [self.one.ids(" " + s) for s in found]
        b = self.other.ids(found)
        a_bytes, b_bytes = self.one.bytes_of, self.other.bytes_of
        whole = np.array([
            b"".join(map(a_bytes.__getitem__, i)) == r == b"".join(map(b_bytes.__getitem__, j))
            for i, j, r in zip(a, b, raw, strict=True)
        ])
        good = np.flatnonzero(whole)
        n_a, n_b = (np.array([len(x[i]) for i in good], np.int64) for x in (a, b))
        one = np.array([t for i in good for t in a[i]], np.int64)
        other = np.array([t for i in good for t in b[i]], np.int64)
        lengths = [np.array([len(of[t]) for t in x.tolist()], np.int64) for of, x in ((a_bytes, one), (b_bytes, other))]
        links = overlap_links(*lengths)
        groups = shared_groups(*lengths)
        both = groups[0].times(groups[1].transposed())

        # Segments follow each other, so token numbers tell which segment a token is of.
        of_a, of_b = np.repeat(np.arange(len(good)), n_a), np.repeat(np.arange(len(good)), n_b)
        linked = links.row_of
        pair = one[linked] << 32 | other[links.indices]
        distinct, at = np.unique(pair, return_inverse=True)
        held = Csr.of_cells(of_a[linked], at, np.ones(len(at), np.int64), len(good), len(distinct))
        count = lambda owner: np.bincount(owner, minlength=len(good))
        n_groups = np.zeros(len(good), np.int64)
        if len(good):
            last = groups[0].indices[np.cumsum(n_a) - 1]
            n_groups = np.diff(np.r_[-1, last])
        sizes = np.zeros((len(found), 5), np.int64)
        sizes[good] = np.stack([n_a, n_b, n_groups, count(of_a[linked]), count(of_a[both.row_of])], axis=1)
        rows = np.zeros(len(found), np.int64)
        rows[good] = np.diff(held.indptr)

        texts = [b""] * len(found)
        for i, text in zip(good.tolist(), _written(one, other, groups, of_a, of_b, len(good)), strict=True):
            texts[i] = text
        self.number |= {s: i for i, s in enumerate(found, len(self.text))}
        self.text += texts
        self.sizes = np.concatenate([self.sizes, sizes])
        self.whole = np.r_[self.whole, whole]
        self.starts = np.r_[self.starts, self.starts[-1] + np.cumsum(rows)]
        self.pairs = np.r_[self.pairs, distinct[held.indices]]
        self.times = np.r_[self.times, held.data]
        self.characters += sum(map(len, found))


def overlap_links(one: np.ndarray, other: np.ndarray) -> Csr:
    """A·Bᵀ: bytes shared by token i of one side and token j of the other, both given by their lengths."""
    return Csr.of_lengths(one).times(Csr.of_lengths(other).transposed())


def shared_groups(one: np.ndarray, other: np.ndarray) -> tuple[Csr, Csr]:
    """Token-group incidences of both sides; groups end where tokens of both end."""
    ends = [np.cumsum(x) for x in (one, other)]
    both = np.intersect1d(*ends)
    return tuple(Csr.of_members(np.searchsorted(both, e), len(both)) for e in ends)


def _written(
    one: np.ndarray, other: np.ndarray, groups: tuple[Csr, Csr], of_a: np.ndarray, of_b: np.ndarray, n: int
) -> list[bytes]:
    """``a1,a2|b1;a3|b2`` for each of ``n`` segments, whose tokens and groups follow each other."""
    sides = []
    for ids, incidence in zip((one, other), groups, strict=True):
        names = [b"%d" % i for i in ids.tolist()]
        ends = incidence.transposed().indptr.tolist()
        sides.append([b",".join(names[s:e]) for s, e in zip(ends, ends[1:], strict=False)])
    written = [a + b"|" + b for a, b in zip(*sides, strict=True)]
    last = np.searchsorted(of_a, np.arange(n), "right") - 1
    ends = [0, *(groups[0].indices[last] + 1).tolist()] if n else [0]
    return [b";".join(written[s:e]) for s, e in zip(ends, ends[1:], strict=False)]


class _Chunk:
    """Documents of one chunk, until it is written."""

    def __init__(self, known: Alignments, with_groups: bool) -> None:
        self.known, self.with_groups = known, with_groups
        self.ids: list = []
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.rows: list[tuple] = []
        self.characters = 0

    @property
    def full(self) -> bool:
        return self.characters >= CHUNK_CHARACTERS or len(self.ids) >= CHUNK_ROWS

    def add(self, ids: list, texts: list[str]) -> None:
        known, none = self.known, np.zeros(0, np.int64)
        found = [segments(t) if t else [] for t in texts]
        new: dict[str, None] = {}
        for of_text in found:
            new.update(dict.fromkeys([s for s in of_text if s not in known.number]))
        if new:
            known.learn(list(new))
        self.ids += ids
        self.characters += sum(map(len, texts))
        for of_text in found:
            numbers = np.array([known.number[s] for s in of_text], np.int64)
            if not len(numbers) or not known.whole[numbers].all():
                self.rows.append((0, 0, 0, 0, 0, "", "" if self.with_groups else None))
                self.parts.append((none, none))
                continue
            written = b";".join([known.text[i] for i in numbers])
            sizes = known.sizes[numbers].sum(axis=0).tolist()
            groups = written.decode() if self.with_groups else None
            self.rows.append((*sizes, hashlib.sha256(written).hexdigest(), groups))
            self.parts.append(np.unique(numbers, return_counts=True))

    def written(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """Rows of documents, then the chunk's dictionary of pairs."""
        known, n = self.known, len(self.ids)
        chunk = int.from_bytes(os.urandom(8), "little", signed=True)
        segments_of = Csr(
            np.r_[0, np.cumsum([len(p) for p, _ in self.parts])].astype(np.int64),
            np.concatenate([p for p, _ in self.parts]), np.concatenate([t for _, t in self.parts]), len(known.text),
        )
        # Numbers of pairs among those the chunk has; only the rows of its own segments matter.
        own = np.unique(segments_of.indices)
        lengths = known.starts[own + 1] - known.starts[own]
        at = ranges(known.starts[own], lengths)
        pairs, inverse = np.unique(known.pairs[at], return_inverse=True)
        links_of = Csr(np.r_[0, np.cumsum(lengths)].astype(np.int64), inverse, known.times[at], len(pairs))
        segments_of.indices = np.searchsorted(own, segments_of.indices)
        segments_of.columns = len(own)
        held = segments_of.times(links_of)
        totals = np.bincount(held.indices, held.data, len(pairs)).astype(np.int64)
        column = dict(zip(_SIZES, zip(*self.rows, strict=True), strict=True))
        ends = held.indptr.tolist()
        numbers, times = held.indices.astype("<u4"), held.data.astype("<u4")
        cut = lambda x: pa.array([x[s:e].tobytes() for s, e in zip(ends, ends[1:], strict=False)], pa.binary())
        yield _batch(schema, n, {
            "id": pa.array(self.ids, schema.field("id").type), "chunk": pa.array([chunk] * n, pa.int64()),
            "pairs": cut(numbers), "times": cut(times),
            **{k: pa.array(v, schema.field(k).type) for k, v in column.items()},
        })
        if len(pairs):
            yield _batch(schema, len(pairs), {
                "chunk": pa.array([chunk] * len(pairs), pa.int64()), "at": pa.array(np.arange(len(pairs))),
                "a": pa.array(pairs >> 32), "b": pa.array(pairs & 0xFFFFFFFF), "n": pa.array(totals),
            })


_SIZES = ("n_a", "n_b", "n_groups", "n_links", "n_group_links", "groups_sha256", "groups")


def _batch(schema: pa.Schema, n: int, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.record_batch([columns.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)


def _aligned(docs: DataFrame, one: str, other: str, with_groups: bool) -> DataFrame:
    """Rows of documents (``at`` null) and of the chunks' dictionaries, as a staged table."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = docs.schema["id"].dataType.simpleString()
    columns = (
        f"id {kind}, chunk long, n_a long, n_b long, n_groups long, n_links long, n_group_links long, "
        "groups_sha256 string, groups string, pairs binary, times binary, at long, a long, b long, n long"
    )
    schema = to_arrow_schema(docs.sparkSession.createDataFrame([], columns).schema)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = worker_memo(("alignments", one, other), lambda: Alignments(one, other))
        chunk = _Chunk(known, with_groups)
        for batch in batches:
            first = 0
            for texts in slices(batch.column(1), _STEP):
                chunk.add(batch.column(0).slice(first, len(texts)).to_pylist(), texts)
                first += len(texts)
                if chunk.full:
                    yield from chunk.written(schema)
                    if known.characters > _MEMORY:
                        known.forget()
                    chunk = _Chunk(known, with_groups)
        if chunk.ids:
            yield from chunk.written(schema)
        if known.characters > _MEMORY:
            known.forget()

    return staged(docs.mapInArrow(align, columns))


def _counted(rows: DataFrame) -> DataFrame:
    counts = staged(rows.filter("at IS NOT NULL").groupBy("a", "b").agg(F.sum("n").alias("count")))
    best = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(best, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def _named(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))


def link_counts(docs: DataFrame, one: str, other: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``a, b, count, best``: how many links of the corpus hold each pair of ids, and whether that is b's highest."""
    return _counted(_aligned(_named(docs, id_column, text_column), one, other, False))


def align_documents(
    docs: DataFrame, one: str, other: str, id_column: str = "doc_id", text_column: str = "text", with_groups: bool = False
) -> DataFrame:
    """Per row of ``docs`` its tokens by both tokenizers, groups, links and how common these are.

    ``one`` is a byte-level ``tokenizers`` file that reads a blank and the text, ``other`` a
    ``sentencepiece`` model that adds the blank itself. ``n_links`` counts pairs of tokens
    whose bytes overlap, ``n_group_links`` those of one group; a link's count is how many
    links of all documents hold its pair of ids; ``n_best`` counts links whose count is the
    highest of their second id, ``count_sum`` adds all counts. ``groups`` (on demand) lists the
    ids of each group, ``groups_sha256`` is its digest.

    A null or empty text, and one whose tokens' bytes are not the text again on either
    side, has no tokens: zeros and empty strings. Repeated rows are rows of their own and
    count as often; null ids stay; other columns are not read; an empty table gives no rows.
    """
    rows = _aligned(_named(docs, id_column, text_column), one, other, with_groups)
    found = rows.filter("at IS NOT NULL").select("chunk", "at", "a", "b").join(_counted(rows), ["a", "b"])
    found = found.select(F.col("chunk").alias("of_chunk"), F.col("at").alias("place"), "count", "best")
    kind = rows.schema["id"].dataType.simpleString()
    kept = ["id", *_SIZES, "n_best", "count_sum"]

    def score(documents: pa.Table, pairs: pa.Table) -> pa.Table:
        counts, best = np.zeros(pairs.num_rows, np.int64), np.zeros(pairs.num_rows, np.int64)
        at = pairs.column("place").to_numpy()
        counts[at] = pairs.column("count").to_numpy()
        best[at] = pairs.column("best").to_numpy(zero_copy_only=False)
        sums: list[list[int]] = [[], []]
        for number, times in zip(documents.column("pairs"), documents.column("times"), strict=True):
            number, times = (np.frombuffer(x.as_py(), "<u4").astype(np.int64) for x in (number, times))
            sums[0].append(int((best[number] * times).sum()))
            sums[1].append(int((counts[number] * times).sum()))
        documents = documents.select(["id", *_SIZES])
        for name, values in zip(kept[-2:], sums, strict=True):
            documents = documents.append_column(name, pa.array(values, pa.int64()))
        return documents

    columns = (
        f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_group_links long, "
        "groups_sha256 string, groups string, n_best long, count_sum long"
    )
    documents = rows.filter("at IS NULL").select("chunk", "id", *_SIZES, "pairs", "times")
    scored = documents.groupBy("chunk").cogroup(found.groupBy("of_chunk")).applyInArrow(score, columns)
    order = [*_SIZES[:4], "n_best", "count_sum", *_SIZES[4:6], *(["groups"] if with_groups else [])]
    return scored.select(F.col("id").alias(id_column), *order)
