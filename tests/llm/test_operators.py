"""Every operator against a brute-force version, with odd rows, and the queries against SQL."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gapledger.llm import (
    byte_gru, decontamination, exact_dedup, language_id, near_dedup, packing, pii, registry, suffix_dedup,
    token_counts, url_rules, warc,
)
from gapledger.llm.dart_minhash import dart_signatures
from tests.compare import duck, rows_of_duck, rows_of_spark

DOCS = "doc_id long, text string, lang string, kept string"
WORDS = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen".split()
LONG = " ".join(f"{a}{b}" for a in WORDS for b in WORDS)
ODD = [
    (1, None, "en", "a"), (2, "", None, None), (3, "Two words", "en", "b"), (4, "two WORDS", "en", "c"),
    (5, LONG, "en", "d"), (6, LONG.replace("oneone", "other"), "en", "e"), (7, "...", "en", "f"),
    (8, "é" * 400, "fr", "g"), (8, "é" * 400, "fr", "g"), (None, "null id here", "en", "h"),
    (9, "mail me at a.b@c.de or 10.0.0.1", "de", "i"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, sf_dir, name):
    assert rows_of_spark(registry.queries()[name](spark, sf_dir)) == rows_of_duck(duck(sf_dir), registry.oracle_sql()[name])


def test_exact_dedup_odd_rows(odd):
    got = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_duplicates(odd).collect()}
    assert {(1, 2, 2, False), (2, 2, 2, True), (3, 4, 2, False), (4, 4, 2, True), (8, 8, 2, True)} <= got
    assert (None, None, 1, True) in got
    kept = exact_dedup.drop_exact_duplicates(odd)
    assert kept.columns == odd.columns and kept.filter("doc_id = 4").first()["kept"] == "c"


def _shingles(text):
    words = re.findall(r"\w+", (text or "").lower())
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def test_cells_shared_by_sets():
    rng = np.random.default_rng(3)
    near = [np.unique(np.r_[rng.integers(0, 40, 30), rng.integers(0, 5000, 4)]).astype(np.uint64) for _ in range(60)]
    far = [np.unique(rng.integers(0, 3000, n)).astype(np.uint64) for n in rng.integers(1, 80, 50)]
    one, other = [*near[:30], *far], [*near[30:], *far[:20]]
    shared = np.array([[len(np.intersect1d(a, b)) for b in other] for a in one])
    assert (near_dedup.common_cells(one, other) == shared).all()
    alike = [[len(np.intersect1d(a, b)) / len(np.union1d(a, b)) >= 0.6 for b in other] for a in one]
    found = np.zeros(shared.shape, bool)
    found[near_dedup.linked_sets(one, other, 0.6)] = True
    assert (found == alike).all()


@pytest.mark.parametrize("pairs_per_text,block", [(1, 1024), (0, 1024), (100, 3)])
def test_near_dedup_against_all_pairs(docs, pairs_per_text, block):
    texts = {r["doc_id"]: _shingles(r["text"]) for r in docs.select("doc_id", "text").collect()}
    label = {i: i for i in texts}
    for a in texts:
        for b in texts:
            if a < b and label[a] != label[b]:
                common = sum((texts[a] & texts[b]).values())
                if common and common >= 0.8 * sum((texts[a] | texts[b]).values()):
                    low, high = sorted((label[a], label[b]))
                    label = {i: low if x == high else x for i, x in label.items()}
    found = near_dedup.near_duplicate_classes(docs, pairs_per_text=pairs_per_text, block=block)
    assert {r["doc_id"]: r["class_id"] for r in found.collect()} == label


def test_near_dedup_odd_rows(odd):
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicate_classes(odd).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 3, 5: 5, 6: 5, 7: 7, 8: 8, 9: 9, None: None}


def test_darts_estimate_weighted_similarity():
    rng = np.random.default_rng(0)
    items = rng.integers(0, 1 << 60, 60).astype(np.uint64)
    one, other = rng.uniform(0.2, 3, 60), rng.uniform(0.2, 3, 60)
    s = dart_signatures(np.r_[items, items], np.r_[one, other], np.repeat([0, 1], 60), 2, 2048)
    assert abs((s[0] == s[1]).mean() - np.minimum(one, other).sum() / np.maximum(one, other).sum()) < 0.05


def test_gradients_of_the_network():
    model = byte_gru.ByteGRU.start(["a", "b"], hidden=3)
    for d in (model.ahead, model.back):
        d.x, d.u, d.b, d.out = (v.astype(np.float64) for v in d.arrays())
    model.bias = model.bias.astype(np.float64)
    given = [b"abc ", b"de "], np.array([0, 1]), np.array([1.0, 2.0])
    _, gradients = model.loss_and_gradients(*given)
    for array, gradient in zip(model.arrays(), gradients, strict=True):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        old, losses = array[at], []
        for step in (1e-5, -1e-5):
            array[at] = old + step
            losses.append(model.loss_and_gradients(*given)[0])
        array[at] = old
        assert gradient[at] == pytest.approx((losses[0] - losses[1]) / 2e-5, rel=1e-3)


def test_language_of_held_out_documents(spark, sf_dir, docs):
    got = registry.op2_language_id(spark, sf_dir).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.9
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_odd_rows(odd):
    model = language_id.fit_language_model(odd, steps=5)
    got = {r["doc_id"]: r for r in language_id.identify_languages(odd, model).collect()}
    assert len(got) == 10 and all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (1, 2, 7))
    assert language_id.fit_language_model(odd.limit(0)) is None


def test_language_without_blanks_is_learned(spark):
    rng = np.random.default_rng(3)
    draw = lambda low, high, n: "".join(map(chr, rng.integers(low, high, n)))
    rows = [(i, draw(0x4E00, 0x5000, 60), "zh") for i in range(80)]
    rows += [(100 + i, draw(0x0E01, 0x0E2F, 60), "th") for i in range(80)]
    rows += [(200 + i, " ".join(draw(97, 123, 5) for _ in range(20)), "en") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    # A bound of so few pieces leaves every language at least one.
    assert language_id.fit_language_model(docs, max_segments=1, steps=1).labels == ["en", "th", "zh"]
    model = language_id.fit_language_model(docs, steps=60)
    found = language_id.identify_languages(docs, model).collect()
    for label in ("zh", "th", "en"):
        own = [r["lang_pred"] == label for r in found if r["lang"] == label]
        assert sum(own) >= 0.9 * len(own), label


def test_more_than_200_languages(spark):
    rows = [(i, f"word{i % 230}", f"l{i % 230:03}") for i in range(1150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labelled = docs.filter(~language_id.held_out(F.col("doc_id"))).select("lang").distinct().count()
    model = language_id.fit_language_model(docs, docs_per_language=2, steps=1)
    assert len(model.labels) == labelled > 200
    assert language_id.identify_languages(docs, model).count() == 1150


def test_decontamination_finds_every_window(spark, sf_dir, docs):
    bench = registry.benchmark(spark, sf_dir)
    items = {r["item_id"]: _shingles(r["text"]) for r in bench.collect()}
    wanted = {}
    for r in docs.collect():
        words = re.findall(r"\w+", r["text"].lower())
        runs = [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))]
        wanted[r["doc_id"]] = sorted(
            i for i, s in items.items() if any(x in s for x in runs) and any(
                sum((w & s).values()) >= 0.8 * sum((w | s).values())
                for k in range(max(1, len(runs) - sum(s.values()) + 1)) for w in [Counter(runs[k : k + sum(s.values())])]
            )
        )
    got = {r["doc_id"]: r["item_ids"] for r in decontamination.contaminated(docs, bench, block_items=17).collect()}
    assert got == wanted and any(wanted.values())


def test_decontamination_odd_rows(spark, odd):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "two words"), (None, "null id here")], "item_id long, text string")
    got = {r["doc_id"]: r["item_ids"] for r in decontamination.contaminated(odd, bench).collect()}
    assert got[3] == got[4] == [3] and got[None] == [] and got[1] == []
    assert decontamination.contaminated(odd, bench.limit(0)).filter("contaminated").count() == 0


def test_packing(spark, sf_dir, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(registry.vocabulary("byte_bpe_50k.json"))
    rows = registry.op3_best_fit_packing(spark, sf_dir).collect()
    pieces = {(r["doc_id"], r["piece"]): r for r in rows}
    for r in docs.collect():
        ids = np.array([*library.encode(r["text"], add_special_tokens=False).ids, 0], "<u4")
        cuts = packing.cut(len(ids))
        assert all(n == 2048 for _, n in cuts[1:])
        for i, (start, n) in enumerate(cuts):
            p = pieces.pop((r["doc_id"], i))
            assert (p["start"], p["length"]) == (start, n)
            assert p["ids_crc32"] == zlib.crc32(ids[start : start + n].tobytes())
    assert not pieces
    ends = Counter()
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 2048 and len(ends) <= sum(ends.values()) / 2048 * 1.01 + 1


def test_packing_odd_rows(odd):
    got = packing.pack_documents(odd, registry.vocabulary("byte_bpe_50k.json")).collect()
    assert sum(r["doc_id"] == 8 for r in got) == 2 and [r["length"] for r in got if r["doc_id"] == 1] == [1]


ODD_TEXTS = ["", " a  b", "x \n y", "<|endoftext|> z", "a<|startoftext|>", "日本 é́", "it's\x1cso\x85", "İ Σς ²³", "\n\n \t q"]


def test_tokens_are_those_of_the_library(docs):
    from tokenizers import Tokenizer

    texts = ODD_TEXTS + [r["text"] for r in docs.limit(60).collect()]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        path = registry.vocabulary(name)
        wanted = [Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids for t in texts]
        if name.startswith("word"):
            counter = token_counts.TokenCounter(path, token_counts.whole_tokens(path))
            assert [counter.count(t) for t in texts] == list(map(len, wanted))
        else:
            reader = packing.BytePairIds(path)
            assert [np.frombuffer(reader.ids(t), "<u4").tolist() for t in texts] == wanted


def test_archives_come_back_and_damage_is_told(spark, tmp_path):
    big = "p" * 1200
    rows = [(1, "http://a/", big), (2, None, big), (3, "http://b/\r\nx", "small"), (4, "u", "small"), (5, "u", None), (None, "u", "n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_archives(warc.page_records(pages), str(tmp_path / "w"))
    got = {r["record_id"]: r for r in warc.read_archives(spark, str(tmp_path / "w")).collect()}
    assert got["<urn:page:1>"]["record_type"] == "revisit" and got["<urn:page:1>"]["refers_to"] == "<urn:page:2>"
    assert bytes(got["<urn:page:2>"]["payload"]).decode() == big and got["<urn:page:1>"]["payload_bytes"] == 1200
    assert got["<urn:page:5>"]["payload_bytes"] == 0 and len(got) == 6
    data = next((tmp_path / "w").glob("part-*")).read_bytes()
    whole = list(warc.salvage(data))
    hurt = data[: whole[1].start + 400] + b"#" + data[whole[1].start + 401 :]
    found = list(warc.salvage(hurt))
    assert [r.reason is None for r in found] == [True, False, True, True, True, True]
    assert (found[1].start, found[1].end) == (whole[1].start, whole[1].end)
    zipped = zlib.compressobj(wbits=31)
    member = zipped.compress(data[: whole[0].end]) + zipped.flush()
    found = list(warc.salvage(member + b"junk" + member[:-9] + member))
    assert [r.reason is None for r in found] == [True, False, True]


def test_archives_with_long_urls(spark, tmp_path):
    url, html = "http://example.org/" + "a" * 100_000, "x" * 2000
    pages = spark.createDataFrame([(1, "http://example.org/", html), (2, url, html)], "page_id long, url string, html string")
    warc.write_archives(warc.page_records(pages), str(tmp_path / "w"))
    got = {r["record_id"]: r for r in warc.read_archives(spark, str(tmp_path / "w")).collect()}
    assert set(got) == {"<urn:page:1>", "<urn:page:2>"}
    assert got["<urn:page:2>"]["target_uri"] == url and got["<urn:page:1>"]["refers_to"] == "<urn:page:2>"


def test_repeated_strings_against_all_positions(spark, docs):
    more = [(9000, None), (9001, "x" * 900), (9002, "y" * 199), (9003, "y" * 200), (9003, "y" * 200), (None, "é" * 300)]
    texts = docs.limit(120).select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in texts.collect()]
    counts = Counter(b[i : i + 200] for _, b in rows for i in range(len(b) - 199))
    wanted = set()
    for i, data in rows:
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - 199):
            if counts[data[s : s + 200]] > 1:
                gone[s : s + 200] = True
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        wanted.add((i, len(data), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    for hot in (2000, 1):
        got = suffix_dedup.repeated_strings(texts, keep_first=False, hot_kinds=hot).collect()
        assert {(r["doc_id"], r["n_bytes"], r["n_removed"], r["kept_sha256"]) for r in got} == wanted
        assert len(got) == len(rows)


def test_repeated_strings_keep_the_first(spark):
    passage = LONG[:500]
    texts = spark.createDataFrame([(2, "b " + passage + " c"), (1, "a! " + passage + " d")], "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.repeated_strings(texts).collect()}
    assert got[1] == 0 and got[2] >= 500


def test_url_rules(spark):
    urls = ["HTTP://A.NET/x", "net/", "http://example.net/en/1?q", "http://w.example.net/en", "http://notnet/", None, "http://x.org", "http://b.org/fr/#a", "http://net"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_rules.judge_urls(pages, registry.URL_RULES).collect()}
    allow = (None, "allow")
    assert got == {0: ("net/", "block"), 1: allow, 2: ("example.net/en/", "allow"), 3: ("net/", "block"), 4: allow,
                   5: allow, 6: allow, 7: ("org/fr/", "allow"), 8: allow}


def test_personal_data_base_spans(spark, docs):
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def good(kind, match):
        digits = [int(c) for c in match if c in "0123456789"]
        if kind == "ip":
            return all(int(x) <= 255 for x in match.split("."))
        if kind == "card":
            total = sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(digits[::-1]))
            return 14 <= len(digits) <= 19 and total % 10 == 0
        return kind == "email" or 10 <= len(digits) <= 15

    more = [(9000, None), (9001, "a@b.c_x@y.z 1.2.3.4.5.6.7.8 256.1.1.1"), (9002, "4111 1111-1111 1111 0 +1 (407) 555-77105"), (9003, "0" * 9000)]
    texts = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = {r["doc_id"]: r for r in pii.span_digests(pii.find_personal_data(texts)).collect()}
    for r in texts.collect():
        found = sorted(
            (m.start(), i, f"{k}:{m.start()}:{m.end()}")
            for i, k in enumerate(plain) for m in re.finditer(plain[k], r["text"] or "") if good(k, m[0])
        )
        joined = [s for *_, s in found]
        assert got[r["doc_id"]]["base_sha256"] == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert set(joined) <= set(got[r["doc_id"]]["spans"].split(",")) or not joined


def test_proposed_emails_in_any_case(spark):
    texts = spark.createDataFrame([(f"anna {at} example.org",) for at in ("(at)", "(At)", "[aT]", "[AT]")], "text string")
    found = texts.select(F.size(pii.candidate_spans(F.col("text"))["proposed"]).alias("n")).collect()
    assert [r["n"] for r in found] == [1, 1, 1, 1]


def test_reliabilities_are_recovered():
    rng = np.random.default_rng(1)
    real = rng.random(20_000) < 0.4
    votes = np.stack([np.where(rng.random(20_000) < a, real, ~real) * 2 - 1 for a in (0.95, 0.8, 0.7)], 1)
    model = pii.estimate_reliability(Counter(map(tuple, votes.tolist())))
    assert abs(model.share - 0.4) < 0.05 and abs(model.real[0][1] - 0.95) < 0.05 and abs(model.other[2][-1] - 0.7) < 0.05


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - {"pipeline"}))
def test_empty_tables(spark, sf_dir, tmp_path, name):
    for table in ("documents", "pages", "benchmark", "embeddings"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert registry.queries()[name](spark, str(tmp_path)).count() == 0


def test_pipeline_stages_and_clean_documents(spark, odd, docs, sf_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "decontamination", "packing"]
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, sf_dir)
        assert kept.columns == docs.columns
    classes = near_dedup.near_duplicate_classes(docs).groupBy("class_id").count().count()
    found = decontamination.contaminated(docs, registry.benchmark(spark, sf_dir)).filter("contaminated").count()
    assert classes - found <= kept.count() <= classes
    assert corpus_pipeline.run(spark, sf_dir).select("doc_id").distinct().count() == kept.count()
