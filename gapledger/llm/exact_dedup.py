"""Exact duplicates: local combining, salted merging, one winner of all salts.

The text itself is a grouping key of both aggregations, so equal digests alone
never make two texts one class. Spark's map-side half of the first aggregation
removes the copies a task holds; the salt spreads what is left of a hot group;
the second aggregation reads at most one row per class and salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapledger.llm.text import free_name, lower_ascii

SALTS = 16
ADDED = ("keep_id", "group_size", "kept", "text_sha256")


def _class_of(text: Column) -> list[Column]:
    """Names a class of equal texts, once their content has been compared."""
    return [
        F.sha2(text, 256).alias("_digest"), F.xxhash64(text).alias("_hash"), F.octet_length(text).alias("_bytes"),
    ]


def duplicate_classes(docs: DataFrame, id_column: str, text: Column, salts: int = SALTS) -> DataFrame:
    """One row per class of equal ``text``: ``_digest, _hash, _bytes, _keep, _size``.

    ``_keep`` is the largest id, null only if every id of the class is null.
    """
    rows = docs.select(F.col(id_column).alias("_id"), text.alias("_text"))
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(salts)))
    by_salt = rows.groupBy("_salt", "_text").agg(F.max("_id").alias("_id"), F.count(F.lit(1)).alias("_n"))
    merged = by_salt.groupBy("_text").agg(F.max("_id").alias("_keep"), F.sum("_n").alias("_size"))
    return merged.select(*_class_of(F.col("_text")), "_keep", "_size")


def exact_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", salts: int = SALTS
) -> DataFrame:
    """Each row of ``docs`` with the row of its class that stays.

    Texts are equal when identical after lower-casing A-Z only; null counts as
    empty. Added columns: ``keep_id`` (largest id of the class), ``group_size``
    (its rows), ``kept``, ``text_sha256``; columns of ``docs`` with such a name give
    way to them.

    Rows that repeat both id and text are one document: they stay or go together.
    A null id never wins against another one and stays only if its class has no
    other. An empty table gives an empty table.
    """
    text = lower_ascii(F.coalesce(F.col(text_column).cast("string"), F.lit("")))
    classes = duplicate_classes(docs, id_column, text, salts)
    names = [free_name(docs, f"_of{i}") for i in range(3)]
    keys = [c.alias(n) for c, n in zip(_class_of(text), names, strict=True)]
    rows = docs.select(*docs.columns, *keys)
    classes = classes.select(*[F.col(c).alias(free_name(docs, f"_class{c}")) for c in classes.columns])
    *of_class, keep, size = [F.col(c) for c in classes.columns]
    joined = rows.join(classes, [F.col(n) == c for n, c in zip(names, of_class, strict=True)])
    return joined.select(
        *[F.col(c) for c in docs.columns if c not in ADDED],
        keep.alias("keep_id"), size.alias("group_size"),
        F.col(id_column).eqNullSafe(keep).alias("kept"), F.col(names[0]).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``."""
    own = {c: free_name(docs, f"_own_{c}") for c in docs.columns if c in ADDED}
    marked = exact_duplicates(docs.withColumns({n: F.col(c) for c, n in own.items()}), id_column, text_column)
    return marked.filter("kept").select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])
