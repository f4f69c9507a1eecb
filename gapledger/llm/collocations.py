"""Phrase collocations by the stripes pattern.

A stripe is a word with an associative counter of what follows it: second words, and third
words below each of them. Each task combines the stripes of its texts before anything is
shuffled; stripes of one word then meet, sorted, and are merged element by element. Ends
of pieces count towards totals only, so a total is the frequency of its prefix: of the word,
and of each pair. Merged elements are the frequencies of the extensions, and the largest
one below a pair tells whether the pair is subsumed by what begins with it.

The stripes of a word with very many followers are cut by a hash of the elements, so that
no task merges all of them; how many followers a word has is counted over all stripes first.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapledger.llm.csr import ranges
from gapledger.llm.shingles import mix
from gapledger.llm.staging import staged

LEAST, SUBSUMED, TOP = 10, 50, 2000
#: Elements of all stripes of a word above which they are cut, into parts of about so many.
CUT_ABOVE = 500_000
#: Rows of a language go through so many parallel first rounds of the ranking.
_RANKED_APART = 64
#: Bytes read at a time; triples and words a task holds before it gives its stripes out.
_STEP, _HELD, _WORDS = 2_000_000, 1_500_000, 1 << 19
#: Elements of the stripes that are built or merged at a time.
_AT_ONCE = 300_000
_END = b"\xff"
_WORD = re.compile(rb"[^ ]+")
_TABLE = bytes(
    0xFF if c in b".,;:!?\n\x0b\x0c\r" else 0x20 if c == 0x09 else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256)
)


class _Numbers(dict):
    """Words by number, in order of appearance; 0 is the end of a piece."""

    def __init__(self) -> None:
        super().__init__({_END: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Stripes:
    """Stripes of one language within one task, as counts of word triples.

    A triple is a prefix of two words and the next word, 0 where the piece has ended.
    """

    def __init__(self, lang: str) -> None:
        self.lang = lang
        self._clear()

    def _clear(self) -> None:
        self.words = _Numbers()
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.loose = 0

    @property
    def held(self) -> int:
        return (len(self.parts[0][0]) if self.parts else 0) + self.loose + len(self.words)

    def read(self, texts: bytes) -> Iterator[pa.RecordBatch]:
        """Count texts in UTF-8 with ``_END`` between them, in runs of bounded size; gives out what is too much to hold."""
        texts = texts.translate(_TABLE).replace(_END, b" \xff ")
        start = 0
        while start < len(texts):
            stop = texts.find(b" ", start + _STEP)
            stop = len(texts) if stop < 0 else stop
            own = texts[start:stop].split()
            # Triples of the run's last words go on into the next.
            ahead = [m.group() for m in itertools.islice(_WORD.finditer(texts, stop), 2)]
            self._count(own + ahead, len(own))
            if self.held > 2 * _HELD or len(self.words) > _WORDS:
                yield from self.written()
            start = stop

    def _count(self, found: list[bytes], own: int) -> None:
        at = np.fromiter(map(self.words.__getitem__, found), np.int64, len(found))
        at = np.r_[at, 0, 0]
        first, second, third = at[:own], at[1 : own + 1], at[2 : own + 2]
        triples = (first << 42 | second << 21 | np.where(second > 0, third, 0))[first > 0]
        self.parts.append(np.unique(triples, return_counts=True))
        self.loose += len(self.parts[-1][0])
        if self.loose > _HELD:
            self._merge()

    def _merge(self) -> None:
        triples, at = np.unique(np.concatenate([t for t, _ in self.parts]), return_inverse=True)
        counts = np.bincount(at, np.concatenate([c for _, c in self.parts]), len(triples)).astype(np.int64)
        self.parts, self.loose = [(triples, counts)], 0

    def written(self) -> Iterator[pa.RecordBatch]:
        """All stripes, which are then forgotten."""
        if not self.parts:
            return
        self._merge()
        triples, counts = self.parts[0]
        words = list(self.words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        first = triples >> 42
        starts = np.flatnonzero(np.r_[True, first[1:] != first[:-1]]) if len(triples) else np.zeros(0, np.int64)
        ends = np.r_[starts[1:], len(triples)].astype(np.int64)
        run = 0
        while run < len(starts):
            stop = max(int(np.searchsorted(ends, starts[run] + _AT_ONCE, "right")), run + 1)
            part = slice(starts[run], ends[stop - 1])
            yield _packed(self.lang, *_elements(triples[part], counts[part]), words, lengths)
            run = stop
        self._clear()


def _elements(triples: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted triples as pairs with totals, and the counts of their third words.

    ``pair`` and ``total`` per pair, the second word 0 where the piece ends after the first;
    ``of`` (which pair), ``third`` and ``count`` per third word, ends left out.
    """
    pairs = triples >> 21
    starts = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
    of = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(triples)]))
    third = triples & _MASK
    inner = third > 0
    return pairs[starts], np.add.reduceat(counts, starts), of[inner], third[inner], counts[inner]


def _packed(
    lang: str, pair: np.ndarray, total: np.ndarray, of: np.ndarray, third: np.ndarray, count: np.ndarray,
    words: list[bytes], lengths: np.ndarray,
) -> pa.RecordBatch:
    """A row per first word: the word, its total, and its pairs with their third words as bytes.

    ``words`` of a row has each second word and then its third words, each before a blank;
    ``lengths`` are those of the given words.
    """
    first, second = pair >> 21, pair & _MASK
    starts = np.flatnonzero(np.r_[True, first[1:] != first[:-1]])
    widths = np.bincount(of, minlength=len(pair))
    named = second > 0
    # Where each second and third word stands in the sequence of all words.
    room = np.where(named, widths + 1, 0)
    at = np.cumsum(room) - room
    sequence = np.zeros(int(room.sum()), np.int64)
    sequence[at[named]] = second[named]
    sequence[np.repeat(at + 1, widths) + ranges(np.zeros(len(widths), np.int64), widths)] = third
    written = b" ".join([*[words[i] for i in sequence.tolist()], b""])
    # A task's own counts fit 32 bits.
    data = [x.astype("<u4").tobytes() for x in (widths[named], total[named], count)]

    def ends(sizes: np.ndarray) -> np.ndarray:
        """Where each row's share begins, given what each pair adds; the end of all at last."""
        before = np.r_[0, np.cumsum(sizes)]
        return before[np.r_[starts, len(pair)]]

    marks = np.r_[0, np.cumsum(lengths[sequence] + 1)][ends(room)], *[4 * ends(x) for x in (named, named, widths)]
    return pa.record_batch([
        pa.array([lang] * len(starts), pa.string()), pa.array([words[f] for f in first[starts].tolist()], pa.binary()),
        pa.array(np.add.reduceat(total, starts)),
        *[_binary(x, m) for x, m in zip((written, *data), marks, strict=True)],
    ], names=_COLUMNS)


def _binary(data: bytes, offsets: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers)


def _bytes_of(array: pa.Array) -> bytes:
    """All values of a binary array without nulls, one after the other."""
    if not len(array):
        return b""
    offsets = np.frombuffer(array.buffers()[1], np.int32)[array.offset : array.offset + len(array) + 1]
    return memoryview(array.buffers()[2] or b"")[offsets[0] : offsets[-1]].tobytes()


def _changes(rows: pa.RecordBatch, keys: list[str], before: tuple | None = None) -> np.ndarray:
    """Whether each row's key differs from that of the row before it; of the first, from ``before``."""
    changed = np.zeros(rows.num_rows, bool)
    changed[0] = tuple(rows.column(k)[0].as_py() for k in keys) != before
    for k in keys:
        column = rows.column(k)
        changed[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    return changed


_MASK = 0x1FFFFF
_COLUMNS = ["lang", "first", "total", "words", "widths", "totals", "counts"]
_STRIPES = "lang string, first binary, total long, words binary, widths binary, totals binary, counts binary"


def stripes(texts: DataFrame) -> DataFrame:
    """Stripes of each task's rows of ``texts`` (``lang``, ``text``), not merged between tasks yet."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Stripes] = {}
        waiting: dict[str, list[bytes]] = {}
        size = 0

        def read() -> Iterator[pa.RecordBatch]:
            for lang, parts in waiting.items():
                yield from held.setdefault(lang, Stripes(lang)).read(_END.join(parts))
            waiting.clear()
            # Many languages together are given out at the same bound as one.
            if sum(s.held for s in held.values()) > 2 * _HELD:
                for lang in list(held):
                    yield from held.pop(lang).written()

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                waiting.setdefault(lang.as_py(), []).append(text.as_py())
                size += len(waiting[lang.as_py()][-1])
                if size > _STEP:
                    yield from read()
                    size = 0
        yield from read()
        for own in held.values():
            yield from own.written()

    return texts.select("lang", "text").mapInArrow(count, _STRIPES)


class _Read:
    """Rows of stripes as arrays: ``row``, ``second`` and ``total`` per pair; ``of``, ``third`` and ``count`` per third word."""

    def __init__(self, rows: pa.RecordBatch) -> None:
        number = _Numbers()
        found = _bytes_of(rows.column("words")).split()
        sequence = np.fromiter(map(number.__getitem__, found), np.int64, len(found))
        joined = lambda c: np.frombuffer(_bytes_of(rows.column(c)), "<u4").astype(np.int64)
        widths, self.total, self.count = (joined(c) for c in ("widths", "totals", "counts"))
        self.words = list(number)
        pairs = pc.binary_length(rows.column("widths")).to_numpy(zero_copy_only=False) // 4
        self.row = np.repeat(np.arange(rows.num_rows), pairs)
        at = np.r_[0, np.cumsum(widths + 1)].astype(np.int64)
        self.second = sequence[at[:-1]]
        self.of = np.repeat(np.arange(len(widths)), widths)
        self.third = np.delete(sequence, at[:-1])


def _cut(stripe: DataFrame, followers: DataFrame) -> DataFrame:
    """Stripes with ``part``: -1, or the part of a stripe that was cut, its word having very many followers.

    A pair's total goes with the pair's hash, its third words by their own.
    """
    parts = F.ceil(F.col("elements") / CUT_ABOVE).cast("int").alias("parts")
    hot = staged(followers.filter(F.col("elements") > CUT_ABOVE).select("lang", "first", parts))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                n, read = row.column("parts")[0].as_py(), _Read(row)
                hashed = np.array([xxhash.xxh3_64_intdigest(w) for w in read.words], np.uint64)
                with_total = hashed[read.second] % np.uint64(n)
                thirds = mix(hashed[read.second[read.of]] * np.uint64(3) + hashed[read.third]) % np.uint64(n)
                for part in np.unique(np.r_[with_total, thirds]).tolist():
                    inner = thirds == part
                    held = with_total == part
                    held[read.of[inner]] = True
                    own = np.flatnonzero(held)
                    place = np.cumsum(held) - 1
                    totals = np.where(with_total == part, read.total, 0)[own]
                    # The word itself is number 0 here.
                    words = [row.column("first")[0].as_py(), *read.words[1:]]
                    out = _packed(
                        row.column("lang")[0].as_py(), read.second[own], totals, place[read.of[inner]],
                        read.third[inner], read.count[inner], words, np.array([len(w) for w in words]),
                    )
                    yield out.append_column("part", pa.array([part], pa.int32()))

    if hot.isEmpty():
        return stripe.withColumn("part", F.lit(-1))
    keys = ["lang", "first"]
    whole = stripe.join(hot, keys, "left_anti").withColumn("part", F.lit(-1))
    return whole.unionByName(stripe.join(hot, keys).mapInArrow(cut, f"{_STRIPES}, part int"))


def _merged(stripe: DataFrame, followers: DataFrame, least: int) -> DataFrame:
    """``lang, first, second, third, f`` of pairs (``third`` null) and triples found at least ``least`` times."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        last, size = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            begins = np.flatnonzero(_changes(batch, keys, last))
            elements = pc.binary_length(batch.column("counts")).to_numpy(zero_copy_only=False) // 4 + 1
            before = np.r_[0, np.cumsum(elements)]
            done = 0
            # Stripes of one word stay together, others are merged some at a time.
            while True:
                enough = begins[(begins >= done) & (before[begins] - before[done] + size > _AT_ONCE)]
                if not len(enough):
                    break
                waiting.append(batch.slice(done, enough[0] - done))
                yield merged(waiting)
                waiting, done, size = [], int(enough[0]), 0
            waiting.append(batch.slice(done))
            size += int(before[-1] - before[done])
            last = tuple(batch.column(k)[batch.num_rows - 1].as_py() for k in keys)
        if waiting:
            yield merged(waiting)

    def merged(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()
        if not rows:
            return pa.record_batch([pa.array([], t) for t in kinds], names=names)
        rows = rows[0]
        read = _Read(rows)
        group = np.cumsum(_changes(rows, keys)) - 1
        wide = len(read.words)
        pairs, at = np.unique(group[read.row] * wide + read.second, return_inverse=True)
        totals = np.bincount(at, read.total, len(pairs)).astype(np.int64)
        # Third words of a pair that is too rare are too; of a stripe that was cut, totals may be elsewhere.
        cut = rows.column("part").to_numpy() >= 0
        often = (totals[at] >= least)[read.of] | cut[read.row[read.of]]
        triples, where = np.unique(at[read.of[often]] * wide + read.third[often], return_inverse=True)
        counts = np.bincount(where, read.count[often], len(triples)).astype(np.int64)
        enough, frequent = np.flatnonzero(totals >= least), np.flatnonzero(counts >= least)
        of = np.r_[pairs[enough], pairs[triples[frequent] // wide]]
        first_row = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])[of // wide]
        words = pa.array([None, *read.words[1:]], pa.binary())
        third = np.r_[np.zeros(len(enough), np.int64), triples[frequent] % wide]
        return pa.record_batch([
            rows.column("lang").take(pa.array(first_row)), rows.column("first").take(pa.array(first_row)),
            words.take(pa.array(of % wide)), words.take(pa.array(third)), pa.array(np.r_[totals[enough], counts[frequent]]),
        ], names=names)

    keys = ["lang", "first", "part"]
    names, kinds = ["lang", "first", "second", "third", "f"], (pa.string(), pa.binary(), pa.binary(), pa.binary(), pa.int64())
    sorted_ = _cut(stripe, followers).repartition(*keys).sortWithinPartitions(*keys)
    return sorted_.mapInArrow(merge, "lang string, first binary, second binary, third binary, f long")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(10^6 a² / (l r)) in 38 decimal places; counts up to 10^15 fit."""
    wide = lambda c: c.cast("decimal(19,0)")
    over = (wide(a) * wide(a)) * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", over.cast("decimal(38,0)"), wide(left) * wide(right)).cast("long")


def collocations(
    docs: DataFrame, text_column: str = "text", lang_column: str = "lang", least: int = LEAST, subsumed: int = SUBSUMED,
    top: int = TOP,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases of two or three words.

    A-Z are lower-cased; pieces end at ``.,;:!?``, line feeds, vertical tabs, form feeds and
    carriage returns; words at blanks and tabs. ``a`` is how often the phrase stands in a piece,
    overlaps included, at least ``least``; ``n`` counts the language's words. The cut whose score
    floor(10^6 a² / (l r)) is lowest gives ``l``, ``r`` and ``score``, the earlier cut at equal scores. A
    phrase goes when one that is a word longer holds it at least ``subsumed`` per cent as often.
    Order: score, ``a``, then the phrase by its bytes.

    A null language is ``und``; a null or empty text has no words; repeated rows count each
    time; other columns, ids included, are not read; an empty table gives no rows.
    """
    texts = docs.select(
        F.coalesce(F.col(lang_column).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    stripe = staged(stripes(texts))
    elements = (F.octet_length("totals") + F.octet_length("counts")) / 4
    followers = staged(
        stripe.groupBy("lang", "first").agg(F.sum("total").alias("f"), F.sum(elements).cast("long").alias("elements"))
    )
    n = followers.groupBy("lang").agg(F.sum("f").alias("n"))
    words = followers.filter(F.col("f") >= least).select("lang", "first", "f")
    found = staged(_merged(stripe, followers, least))
    pairs = found.filter(F.col("third").isNull()).drop("third")
    triples = found.filter(F.col("third").isNotNull())

    longer = triples.select("lang", "first", "second", "f").union(
        triples.select("lang", F.col("second").alias("first"), F.col("third").alias("second"), "f")
    )
    longest = longer.groupBy("lang", "first", "second").agg(F.max("f").alias("longest"))
    word = lambda c, f: words.select("lang", F.col("first").alias(c), F.col("f").alias(f))
    two = pairs.join(longest, ["lang", "first", "second"], "left").filter(
        F.col("longest").isNull() | (100 * F.col("longest") < subsumed * F.col("f"))
    )
    two = two.join(word("first", "left"), ["lang", "first"]).join(word("second", "right"), ["lang", "second"]).select(
        "lang", F.concat_ws(" ", *[F.col(c).cast("string") for c in ("first", "second")]).alias("phrase"),
        F.col("f").alias("a"), F.col("left").alias("l"), F.col("right").alias("r"),
        _score(F.col("f"), F.col("left"), F.col("right")).alias("score"),
    )
    pair = lambda a, b, f: pairs.select(
        "lang", F.col("first").alias(a), F.col("second").alias(b), F.col("f").alias(f)
    )
    three = (
        triples.join(word("first", "l1"), ["lang", "first"]).join(word("third", "r2"), ["lang", "third"])
        .join(pair("first", "second", "l2"), ["lang", "first", "second"])
        .join(pair("second", "third", "r1"), ["lang", "second", "third"])
    )
    early, late = _score(F.col("f"), F.col("l1"), F.col("r1")), _score(F.col("f"), F.col("l2"), F.col("r2"))
    first = F.col("early") <= F.col("late")
    three = three.withColumns({"early": early, "late": late}).select(
        "lang", F.concat_ws(" ", *[F.col(c).cast("string") for c in ("first", "second", "third")]).alias("phrase"),
        F.col("f").alias("a"), F.when(first, F.col("l1")).otherwise(F.col("l2")).alias("l"),
        F.when(first, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("early", "late").alias("score"),
    )

    # A language's phrases are thinned in parts before one task ranks what can be among its first.
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    apart = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(_RANKED_APART))).orderBy(*order)
    thinned = two.union(three).withColumn("rank", F.row_number().over(apart)).filter(F.col("rank") <= top)
    ranked = thinned.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= top).join(n, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
