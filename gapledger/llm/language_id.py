"""Language of whole documents by a byte-level recurrent network (``byte_gru``).

A text is cut at white space into segments, and a segment with one closing blank into
pieces of at most ``PIECE`` bytes. The network reads each piece on its own, with no state
from other pieces, and labels every byte position. A document's probabilities
are the mean over all its positions. Equal segments get equal labels, so a task
reads a segment once and then adds its sums for every place where it stands.

The network is fitted on the driver on pieces cut the same way: at most ``max_segments``
distinct (piece, language) pairs, and one of each language left out by that, of documents
sampled by a hash of their id, about ``docs_per_language`` of each language. Only text and
label of documents whose
``crc32(id as text) mod 4`` is not 2 are used; the rest is for held-out accuracy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapledger.llm.byte_gru import PIECE, ByteGRU
from gapledger.llm.text import free_name
from gapledger.llm.workers import slices

UNKNOWN = "und"
_HASH_RANGE = 1 << 30
#: Segments a task remembers, and characters of text it works on at a time; both
#: shrink in proportion where there are more labels than _LABELS.
_MEMORY, _SLICE, _LABELS = 300_000, 2_000_000, 200
#: What Python's str.split takes for white space.
_BLANKS = r"(?U)[\s\x1c-\x1f]+"


def held_out(id_column: Column) -> Column:
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_language_model(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang",
    docs_per_language: int = 400, max_segments: int = 40_000, steps: int = 300,
) -> ByteGRU | None:
    """The trained network, or None where no document has both text and label."""
    rows = docs.select(
        F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"),
        F.col(label_column).cast("string").alias("label"),
    ).filter(~held_out(F.col("id")) & F.col("label").isNotNull() & F.col("text").isNotNull())
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    labels = sorted(sizes)
    if not labels:
        return None
    place = F.pmod(F.xxhash64("id"), F.lit(_HASH_RANGE))
    # One flat map, as a condition per label would nest as deep as there are labels.
    large = {label: int(docs_per_language / n * _HASH_RANGE) for label, n in sizes.items() if n > docs_per_language}
    if large:
        most = F.create_map(*[F.lit(x) for pair in sorted(large.items()) for x in pair])
        rows = rows.filter(place < F.coalesce(F.try_element_at(most, F.col("label")), F.lit(_HASH_RANGE)))
    words = rows.select("label", F.explode(F.split("text", _BLANKS)).alias("segment")).filter("segment != ''")
    coded = words.select("label", F.concat("segment", F.lit(" ")).cast("binary").alias("coded"))
    starts = F.sequence(F.lit(1), F.octet_length("coded"), F.lit(PIECE))
    pieces = F.transform(starts, lambda at: F.substring(F.col("coded"), at, F.lit(PIECE)))
    counted = coded.select("label", F.explode(pieces).alias("piece")).groupBy("piece", "label").agg(
        F.count(F.lit(1)).alias("n")
    )
    place = F.xxhash64("piece", "label")
    found = counted.orderBy(place, "piece", "label").limit(max_segments).collect()
    if not found:
        return None
    if len(found) == max_segments and (left := sorted(set(labels) - {r["label"] for r in found})):
        rest = counted.filter(F.col("label").isin(left)).groupBy("label")
        first = rest.agg(F.min(F.struct(place.alias("place"), "piece", "n")).alias("first"))
        found += first.select("label", "first.piece", "first.n").orderBy("label").collect()
    segments = [bytes(r["piece"]) for r in found]
    number = {label: i for i, label in enumerate(labels)}
    truth = np.array([number[r["label"]] for r in found])
    # Each language weighs the same; within one, frequent segments count by a root.
    weight = np.sqrt(np.array([r["n"] for r in found], float))
    for i in range(len(labels)):
        if (of := truth == i).any():
            weight[of] /= weight[of].sum()
    return ByteGRU.start(labels).train(segments, truth, weight, steps=steps)


def _fitting(size: int, labels: list[str]) -> int:
    return max(1, size * _LABELS // max(_LABELS, len(labels)))


class _Memory(dict):
    """Segment to row of the sums; new ones wait in ``pending``."""

    def __init__(self) -> None:
        super().__init__()
        self.pending: list[str] = []

    def __missing__(self, segment: str) -> int:
        self.pending.append(segment)
        self[segment] = at = len(self)
        return at


class Labeller:
    """Pools the positions of whole texts; remembers segments between texts."""

    def __init__(self, model: ByteGRU) -> None:
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.memory = _Memory()
        self.sums = np.zeros((0, len(self.model.labels)), np.float32)
        self.lengths = np.zeros(0, np.int64)

    def _read_pending(self) -> None:
        """Sums of the new segments; those beyond ``PIECE`` bytes are read piece by piece."""
        if not self.memory.pending:
            return
        coded = [s.encode("utf-8", "surrogatepass") + b" " for s in self.memory.pending]
        self.memory.pending.clear()
        pieces = [c[at : at + PIECE] for c in coded for at in range(0, len(c), PIECE)]
        lengths = np.fromiter(map(len, coded), np.int64, len(coded))
        ends = np.cumsum(-(-lengths // PIECE))
        sums = np.add.reduceat(self.model.segment_sums(pieces), ends - -(-lengths // PIECE), axis=0)
        self.sums = np.concatenate([self.sums, sums])
        self.lengths = np.concatenate([self.lengths, lengths])

    def probabilities(self, texts: list[str]) -> np.ndarray:
        """Mean position probabilities, a row per text; zero rows for texts of white space."""
        if len(self.memory) > _fitting(_MEMORY, self.model.labels):
            self._forget()
        counts, found = [], []
        for text in texts:
            segments = text.split()
            counts.append(len(segments))
            found.append(np.fromiter(map(self.memory.__getitem__, segments), np.int64, len(segments)))
        self._read_pending()
        result = np.zeros((len(texts), len(self.model.labels)))
        if full := [i for i, n in enumerate(counts) if n]:
            every = np.concatenate(found)
            starts = np.cumsum([0, *(counts[i] for i in full)])[:-1]
            sums = np.add.reduceat(self.sums[every], starts, axis=0, dtype=np.float64)
            result[full] = sums / np.add.reduceat(self.lengths[every], starts)[:, None]
        return result


def _label(model: ByteGRU, texts: pa.Array, labeller: Labeller) -> pa.Array:
    languages: list[str] = []
    scores: list[float] = []
    for part in slices(texts, _fitting(_SLICE, model.labels)):
        for text, row in zip(part, labeller.probabilities(part), strict=True):
            known = any(map(str.isalpha, text)) and row.sum() > 0
            languages.append(model.labels[int(row.argmax())] if known else UNKNOWN)
            scores.append(float(min(1.0, row.max())) if known else 0.0)
    return pa.StructArray.from_arrays(
        [pa.array(languages, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"]
    )


def identify_languages(
    docs: DataFrame, model: ByteGRU | None, text_column: str = "text",
    language_column: str = "lang_pred", score_column: str = "score",
) -> DataFrame:
    """``docs`` with the predicted language and the pooled probability of it.

    ``und`` and 0 where the text is null or has no letter, and everywhere without a
    model. Columns of ``docs`` with the names of the new ones give way to them. Texts
    of any length are read whole; repeated rows and an empty table stay as they are.
    """
    kept = [c for c in docs.columns if c not in (language_column, score_column)]
    if model is None:
        return docs.select(
            *kept, F.lit(UNKNOWN).alias(language_column), F.lit(0.0).cast("double").alias(score_column)
        )

    def label(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        labeller = Labeller(model)
        for texts in batches:
            yield _label(model, texts, labeller)

    label.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    # Else a filter on the result would be evaluated below it, and the texts read twice.
    labelled = F.arrow_udf(label, "lang_pred string, score double").asNondeterministic()
    found = free_name(docs, "_found")
    rows = docs.withColumn(found, labelled(F.col(text_column).cast("string")))
    return rows.select(
        *kept, F.col(f"{found}.lang_pred").alias(language_column), F.col(f"{found}.score").alias(score_column)
    )
