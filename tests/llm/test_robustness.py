"""Texts and records that are very long, odd or foreign, and what of one row must not depend on others."""

from __future__ import annotations

import gzip
import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings as limits
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from gapledger.llm import decontamination, packing, pii, registry, suffix_dedup, warc
from tests.llm.test_operators import _shingles

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


# Personal data.


def _emails(text):
    return [(m.start(), m.end()) for m in EMAIL.finditer(text or "")]


def test_names_of_very_many_labels(spark):
    many = ".a" * 100_000
    texts = [
        f"x@a{many}", f"write to x@a{many}. or y@b.cc", f"{'a.' * 50_000}@b.cc", f"x@{'a' * 200_000}", "@" * 100_000,
        f"someone (at) host{' dot'.join(['.com'] * 3)}", f"someone (at) host{'.com' * 100_000}",
        f"someone (at) host{' (dot) com' * 50_000}!", "a@b.c d@e.f@g.h -@-.-", None, "",
    ]
    # Null and repeated ids, and columns named like the results.
    rows = [(None if i == 1 else i // 2, t, "x", 5) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_email int").repartition(4)
    found = pii.find_personal_data(docs.withColumn("size", F.length("text"))).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in rows)
    got = sorted([(s["start"], s["end"]) for s in r["base_spans"] if s["rank"] == 0] for r in found)
    assert got == sorted(_emails(t) for t in texts)


def test_proposed_emails_end_where_they_did(spark):
    former = re.compile(
        r"(?i)\b[a-z0-9._-]{2,40} ?[\[(]at[\])] ?[a-z0-9-]{2,40}(?: ?(?:\.|[\[(]dot[\])]) ?[a-z]{2,10})+\b", re.ASCII
    )
    rng = random.Random(7)
    bits = ["me", "x1", "(at)", "[AT]", ".com", " .", "(dot)", "[dot] org", "averyverylonglabel", "co", ".", "-", " ", "9", "_"]
    texts = ["".join(rng.choices(bits, k=rng.randint(3, 14))) for _ in range(3_000)] + ["me (at) host.com.abcdefghijklmn"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = rows.select("i", pii._matches(F.col("t"), pii.PROPOSED["email"]).alias("m")).collect()
    got = {r["i"]: [(x["start"], x["end"]) for x in r["m"]] for r in found}
    assert got == {i: [m.span() for m in former.finditer(t)] for i, t in enumerate(texts)}
    assert sum(map(len, got.values())) > 50


def test_repeated_documents_have_the_same_spans(spark):
    rows = [(1, "mail a.b@c.de now")] * 3 + [(2, "ip 10.0.0.1"), (None, "+1 202 555 0100"), (None, "+1 202 555 0100")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in pii.span_digests(pii.find_personal_data(docs)).collect()]
    assert len(got) == 6 and len(set(got)) == 3


def test_counts_and_digests_of_base_spans(spark):
    import hashlib

    text = "a@b.c 1.2.3.4, 4111 1111 1111 1111, call +1 202 555 0100"
    row = pii.span_digests(pii.find_personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string"))).first()
    spans = "email:0:5,ip:6:13,card:15:34,phone:41:56"
    assert tuple(row)[1:5] == (1, 1, 1, 1)
    assert row["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest() and row["spans"] == spans


# Benchmark decontamination.


def _windows_of_own_width(text, items, similarity=0.8):
    words = re.findall(r"\w+", (text or "").lower())
    found = set()
    for id_, item in items:
        sought = re.findall(r"\w+", item.lower())
        if not sought:
            continue
        width = min(len(sought), len(words))
        for start in range(max(len(words) - width, 0) + 1):
            one, two = _shingles(" ".join(words[start : start + width])), _shingles(item)
            if len(sought) < 5:
                one = {tuple(words[start : start + len(sought)]): 1}
                one = type(two)(one)
            common, whole = sum((one & two).values()), sum((one | two).values())
            if common and common >= similarity * whole:
                found.add(id_)
    return found


@pytest.mark.parametrize("block_items", [5_000, 1])
def test_items_are_found_whatever_the_others_are(spark, block_items):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    long = [word() for _ in range(30)]
    # Of an item of 30 words the document has 25; another item is as wide as these and shares a phrase.
    other = long[5:10] + [word() for _ in range(20)]
    items = [(1, " ".join(other)), (2, " ".join(long)), (3, " ".join(long[:25])), (4, "one two three"), (5, " ".join(long[3:9]))]
    noise = lambda n: " ".join(word() for _ in range(n))
    docs = [
        (1, f"{noise(40)} {' '.join(long[:25])} {noise(40)}"), (2, f"{noise(9)} {' '.join(long)}"), (3, " ".join(long[:28])),
        (4, "zero one two three four"), (5, f"{noise(30)} {' '.join(other)} {noise(3)}"), (6, noise(50)),
    ]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    for kept in (items, items[1:], items[1:2], items[:2]):
        benchmark = spark.createDataFrame(kept, "item_id long, text string")
        got = decontamination.contaminated(table, benchmark, block_items=block_items).collect()
        assert {r["doc_id"]: set(r["item_ids"]) for r in got} == {i: _windows_of_own_width(t, kept) for i, t in docs}
    alone = decontamination.contaminated(table, spark.createDataFrame(items[1:2], "item_id long, text string"))
    assert not alone.filter("doc_id = 1").first()["contaminated"]


# Archives.


def _record(kind, block, **fields):
    lines = {"WARC-Type": kind, "WARC-Record-ID": "<urn:page:1>", "Content-Length": str(len(block)), **fields}
    return ("WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines.items()) + "\r\n").encode() + block + b"\r\n\r\n"


def test_foreign_records_are_set_aside_not_raised(spark, tmp_path):
    good = _record("response", b"HTTP/1.1 200 OK\r\n\r\npayload")
    odd = [_record("revisit", f"HTTP/1.1 200 OK\r\nContent-Length: {n}\r\n\r\n".encode()) for n in ("many", "", "-1", "1e3")]
    fine = _record("revisit", b"HTTP/1.1 200 OK\r\nContent-Length: 12\r\n\r\n")
    (tmp_path / "part-0.warc").write_bytes(good + b"".join(odd) + fine + good)
    rows = warc.read_archives(spark, str(tmp_path)).orderBy("start").collect()
    assert [r["quarantined"] for r in rows] == [None] + ["revisit declares no length"] * 4 + [None, None]
    assert [r["payload_bytes"] for r in rows if r["quarantined"] is None] == [7, 12, 7]
    assert [r["start"] for r in rows[1:]] == [r["end"] for r in rows[:-1]]


def test_members_take_time_by_their_own_length():
    member = gzip.compress(_record("response", b"HTTP/1.1 200 OK\r\n\r\n" + random.Random(1).randbytes(8_000)))

    def seconds(n):
        data, start = member * n, time.perf_counter()
        assert sum(r.reason is None for r in warc.salvage(data)) == n
        return time.perf_counter() - start

    seconds(50)
    # Linear would be four times as long; it was over seventy.
    assert seconds(2_000) < 12 * min(seconds(500), seconds(500))


def test_members_that_inflate_to_too_much(monkeypatch):
    monkeypatch.setattr(warc, "_MOST_INFLATED", 100_000)
    bomb = gzip.compress(_record("response", b"\r\n\r\n" + b"0" * 1_000_000))
    good = gzip.compress(_record("response", b"HTTP/1.1 200 OK\r\n\r\nx"))
    found = list(warc.salvage(good + bomb + good))
    assert [r.reason for r in found] == [None, "gzip member inflates to too much", None]


# Repeated strings.


@pytest.mark.parametrize("keep_first", [False, True])
def test_rows_that_repeat_id_and_text_take_linear_time(spark, keep_first):
    rng = random.Random(4)
    text = "".join(rng.choices("abcdefghij ", k=4_000))
    other = "".join(rng.choices("abcdefghij ", k=500)) + text[1_000:1_500]

    def run(n):
        docs = spark.createDataFrame([(1, text)] * n + [(2, other)], "doc_id long, text string").repartition(8)
        start = time.perf_counter()
        rows = suffix_dedup.repeated_strings(docs, keep_first=keep_first).collect()
        return rows, time.perf_counter() - start

    _, few = run(100)
    rows, many = run(800)
    spans = {(r["doc_id"], r["n_removed"], r["n_spans"]) for r in rows}
    assert len(rows) == 801
    if not keep_first:
        assert spans == {(1, 4_000, 1), (2, 500, 1)}
        assert all([tuple(s) for s in r["spans"]] == [(0, 4_000) if r["doc_id"] == 1 else (500, 1_000)] for r in rows)
    assert many < 8 * few + 10


# Packing.


def _naive_best_fit(lengths, capacity):
    """Longest first, each into the sequence with the least room that is enough; rooms in order of opening."""
    left, out = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [(room, n) for n, room in enumerate(left) if room >= lengths[i]]
        if fits:
            n = min(fits)[1]
        else:
            n = len(left)
            left.append(capacity)
        out[i] = capacity - left[n]
        left[n] -= lengths[i]
    return sorted(left), out


@given(st.integers(1, 60), st.data())
@limits(max_examples=150, deadline=None)
def test_packing_is_as_tight_as_naive_best_fit(capacity, data):
    lengths = np.array(data.draw(st.lists(st.integers(1, capacity), max_size=80)), np.int64)
    sequence, offset = packing.best_fit_decreasing(lengths, capacity)
    used = np.bincount(sequence, lengths, sequence.max(initial=-1) + 1).astype(int)
    room, offsets = _naive_best_fit(lengths.tolist(), capacity)
    # Sequences of equal room may stand in for each other; the rooms that are left are the same.
    assert sorted((capacity - used).tolist()) == room
    assert sorted(offset.tolist()) == sorted(offsets.values())
    for n in range(len(used)):
        own = np.flatnonzero(sequence == n)
        own = own[np.argsort(offset[own])]
        assert (offset[own] == np.cumsum(lengths[own]) - lengths[own]).all()


def test_equal_rows_are_spread_over_all_shards(spark):
    pieces = spark.range(30_000).select(F.lit(1).alias("doc_id"), F.lit("x").alias("_place"), F.lit(700).cast("long").alias("length"))
    packed = packing.pack(pieces, shard_pieces=10_000)
    assert packed.columns == [*pieces.columns, "sequence_id", "offset"]
    sizes = [r["count"] for r in packed.groupBy(F.shiftright("sequence_id", 32)).count().collect()]
    assert len(sizes) == 3 and max(sizes) < 11_000 and sum(sizes) == 30_000
    assert packed.select("sequence_id").distinct().count() <= 15_000 + 3


# The pipeline.


def _classes(texts):
    label = {i: i for i in texts}
    shingles = {i: _shingles(t) for i, t in texts.items()}
    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = sum((shingles[a] & shingles[b]).values())
            if common and common >= 0.8 * sum((shingles[a] | shingles[b]).values()):
                low, high = sorted((label[a], label[b]))
                label = {i: low if x == high else x for i, x in label.items()}
    return label


def test_pipeline_keeps_what_brute_force_keeps(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = registry.benchmark(spark, sf_dir)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    # Language id drops what has no letter; of equal texts the last stays, of a near class the first.
    kept = {i: t for i, t in texts.items() if any(c.isalpha() for c in t or "")}
    lower = lambda t: re.sub("[A-Z]", lambda m: m.group().lower(), t)
    last = {lower(t): i for i, t in sorted(kept.items())}
    kept = {i: kept[i] for i in last.values()}
    label = _classes(kept)
    kept = {i: t for i, t in kept.items() if label[i] == i}
    items = [(r["item_id"], r["text"]) for r in benchmark.collect() if r["text"]]
    found = decontamination.contaminated(docs, benchmark)  # itself held against brute force elsewhere
    hit = {r["doc_id"] for r in found.filter("contaminated").collect()}
    want = {i for i in kept if i not in hit}
    assert items and {r["doc_id"] for r in corpus_pipeline.run(spark, sf_dir).select("doc_id").distinct().collect()} == want


def test_pipeline_stages_on_empty_and_clashing_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40)
    clash = docs.withColumns({c: F.lit("x") for c in ("class_id", "keep_id", "_language", "contaminated", "id", "band", "kept")})
    for rows in (clash, clash.limit(0), docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, rows, sf_dir)
            assert out.columns == rows.columns, name
            assert out.count() <= rows.count()
        assert corpus_pipeline.STAGES[-1][1](spark, rows, sf_dir).count() >= rows.count()
