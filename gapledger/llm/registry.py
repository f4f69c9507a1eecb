"""One query per operator, over its whole table, and the SQL twins that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapledger.llm import (
    alignment, collocations, decontamination, embedding_dedup, exact_dedup, language_id, near_dedup, packing, pii,
    suffix_dedup, token_counts, url_rules, warc,
)
from gapledger.llm.staging import staging_folder

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = (
    url_rules.UrlRule("block", "net", "/"),
    url_rules.UrlRule("allow", "example.net", "/en/"),
    url_rules.UrlRule("block", "example.com", "/de/"),
    url_rules.UrlRule("allow", "org", "/fr/"),
)


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_dedup.near_duplicate_classes(_documents(spark, sf_dir))
    return classes.select("doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = language_id.fit_language_model(docs)
    found = language_id.identify_languages(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{staging_folder(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archives(warc.page_records(_pages(spark, sf_dir)), folder)
    read = warc.read_archives(spark, folder, with_payload=False).filter("quarantined IS NULL")
    page_of = lambda c: F.regexp_extract(c, r"^<urn:page:(-?[0-9]*)>$", 1).try_cast("long")
    return read.select(
        page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page_of(F.col("refers_to")).alias("refers_to"),
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    docs = docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    counted = token_counts.count_tokens(docs, vocabulary("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return decontamination.contaminated(docs, benchmark(spark, sf_dir)).drop("text")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_strings(_documents(spark, sf_dir), keep_first=False).drop("spans")


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(_pages(spark, sf_dir), URL_RULES)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digests(pii.find_personal_data(_documents(spark, sf_dir)))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return exact_dedup.exact_duplicates(docs).drop("text")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_documents(spark, sf_dir))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(
        _documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    )


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_dedup.near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def queries() -> dict[str, Query]:
    import corpus_pipeline

    return {
        "op1_near_dedup": op1_near_dedup,
        "op2_language_id": op2_language_id,
        "op3_best_fit_packing": op3_best_fit_packing,
        "op4_warc": op4_warc,
        "op5_token_counts": op5_token_counts,
        "op6_decontamination": op6_decontamination,
        "op7_suffix_dedup": op7_suffix_dedup,
        "op8_url_rules": op8_url_rules,
        "op9_pii": op9_pii,
        "op10_exact_dedup": op10_exact_dedup,
        "op11_collocations": op11_collocations,
        "op12_tokenizer_alignment": op12_tokenizer_alignment,
        "op13_embedding_dedup": op13_embedding_dedup,
        "pipeline": corpus_pipeline.run,
    }


_OP4_SQL = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS payload_bytes FROM pages
), f AS (
    SELECT payload, max(page_id) AS first FROM p WHERE payload_bytes >= 1000 GROUP BY payload
)
SELECT p.page_id, p.payload_bytes, sha1(p.payload) AS payload_digest,
    CASE WHEN f.payload IS NOT NULL AND p.page_id IS DISTINCT FROM f.first THEN 'revisit' ELSE 'response' END
        AS record_type,
    CASE WHEN f.payload IS NOT NULL AND p.page_id IS DISTINCT FROM f.first THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.payload = f.payload
"""

_OP8_SQL = """
WITH u AS (
    SELECT page_id,
        regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1) AS raw_host,
        regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), h AS (
    SELECT page_id, path,
        translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
    FROM u
), r(rule_host, rule_path, verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
        ('org', '/fr/', 'allow')
), fit AS (
    SELECT h.page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
        max_by(r.verdict, length(rule_host || rule_path)) AS verdict
    FROM h JOIN r ON (h.host = rule_host OR ends_with(h.host, '.' || rule_host)) AND starts_with(h.path, rule_path)
    GROUP BY h.page_id
)
SELECT h.page_id, h.host, h.path, fit.rule, coalesce(fit.verdict, 'allow') AS verdict
FROM h LEFT JOIN fit ON h.page_id = fit.page_id
"""

_OP10_SQL = """
WITH d AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
), g AS (
    SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t
)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""

_OP11_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
), starts AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), grams AS (
    SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
    FROM starts, (VALUES (1), (2), (3)) AS s(k) WHERE i + k - 1 <= len(w)
), f AS (
    SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL
), n AS (
    SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
), c AS (
    SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 10
), cuts AS (
    SELECT c.lang, c.phrase, c.k, c.a, x.k AS cut, x.a AS l, y.a AS r,
        CAST((1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
    FROM c JOIN f x ON x.lang = c.lang AND x.k < c.k AND x.phrase = array_to_string(c.w[1 : x.k], ' ')
        JOIN f y ON y.lang = c.lang AND y.k = c.k - x.k AND y.phrase = array_to_string(c.w[x.k + 1 : c.k], ' ')
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), within AS (
    SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM c WHERE k = 3
), longest AS (
    SELECT lang, phrase, max(a) AS longest FROM within GROUP BY ALL
), ranked AS (
    SELECT lowest.*, row_number() OVER (
        PARTITION BY lowest.lang ORDER BY score DESC, a DESC, encode(lowest.phrase)) AS rank
    FROM lowest LEFT JOIN longest ON lowest.lang = longest.lang AND lowest.phrase = longest.phrase AND lowest.k = 2
    WHERE longest IS NULL OR 100 * longest < 50 * a
)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n ON ranked.lang = n.lang WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_warc": _OP4_SQL, "op8_url_rules": _OP8_SQL, "op10_exact_dedup": _OP10_SQL,
        "op11_collocations": _OP11_SQL,
    }
