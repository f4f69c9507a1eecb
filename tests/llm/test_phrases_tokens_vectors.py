"""Collocations, tokenizer alignment and near-duplicate vectors against brute force, with odd rows."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings as limits
from hypothesis import strategies as st

from gapledger.llm import alignment, collocations, embedding_dedup, registry
from gapledger.llm.csr import Csr

ONE, OTHER = registry.vocabulary("byte_bpe_50k.json"), registry.vocabulary("piece_bpe_32k.model")


# Phrase collocations.


def _collocations(rows, least=10, subsumed=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        found = []
        for p, a in counts.items():
            if len(p) == 1 or a < least:
                continue
            longer = [b for q, b in counts.items() if len(q) == 3 > len(p) and b >= least and p in (q[:2], q[1:])]
            if any(100 * b >= subsumed * a for b in longer):
                continue
            cuts = [(1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def _rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


PHRASES = [
    ("en", "The cat sat, the cat ran. THE CAT\tsat"), ("en", None), ("en", ""), (None, "no lang here no lang"),
    ("fr", "é É é É,É é;\x0b a a a a a a"), ("en", "the cat sat"), ("en", "the cat sat"), ("", "empty lang empty lang"),
    ("en", " \t . ,,; "), ("xx", "w w w w w w"), ("en", "a\xa0b c a\xa0b c a\xa0b c"),
]


@pytest.mark.parametrize("least,subsumed,top", [(2, 50, 2000), (1, 101, 3), (3, 90, 2000)])
def test_collocations_odd_rows(spark, least, subsumed, top):
    docs = spark.createDataFrame([(*r, "x", 1) for r in PHRASES], "lang string, text string, rank string, n int")
    got = _rows_of(collocations.collocations(docs, least=least, subsumed=subsumed, top=top))
    assert got == _collocations(PHRASES, least, subsumed, top)
    assert collocations.collocations(docs.limit(0)).count() == 0


@pytest.mark.parametrize("bounds", [{"_STEP": 40, "_HELD": 30, "_WORDS": 10, "_AT_ONCE": 5}, {"CUT_ABOVE": 2}])
def test_collocations_in_small_runs_and_cut_stripes(spark, monkeypatch, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(collocations, name, value)
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(12)] + ["the"] * 6
    rows = [("en" if i % 3 else "de", " ".join(rng.choice(words, 60)) + rng.choice([".", ""])) for i in range(30)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    assert _rows_of(collocations.collocations(docs, least=3)) == _collocations(rows, 3)


def test_scores_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    a, left, right = 3 * 10**12 + 7, 5 * 10**12 + 11, 4 * 10**12 + 3
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    got = row.select(collocations._score(F.col("a"), F.col("l"), F.col("r"))).first()[0]
    assert got == 1_000_000 * a * a // (left * right)


# Alignment.


@given(st.data())
@limits(max_examples=60, deadline=None)
def test_row_product_is_the_matrix_product(data):
    rows, inner, columns = (data.draw(st.integers(0, 6)) for _ in range(3))
    dense = lambda n, m: np.array(
        data.draw(st.lists(st.integers(0, 2), min_size=n * m, max_size=n * m)), np.int64
    ).reshape(n, m)
    one, other = dense(rows, inner), dense(inner, columns)
    sparse = lambda d: Csr.of_cells(*np.nonzero(d), d[np.nonzero(d)], *d.shape)

    def filled(m):
        out = np.zeros((m.rows, m.columns), np.int64)
        out[m.row_of, m.indices] = m.data
        return out

    assert (filled(sparse(one).times(sparse(other))) == one @ other).all()
    assert (filled(sparse(one).transposed()) == one.T).all()


def _aligned(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    from gapledger.llm.bpe import ranks_of

    tokenizer = Tokenizer.from_file(ONE)
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=OTHER)
    a_bytes = {i: b for b, i in ranks_of(ONE).items()}
    piece = lambda i: (
        bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
    )
    count, rows = Counter(), []
    for text in texts:
        raw = (" " + (text or "")).encode()
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        if not text or b"".join(a_bytes[i] for i in a) != raw or b"".join(map(piece, b)) != raw:
            rows.append(None)
            continue
        ends = [np.cumsum([len(x) for x in side]) for side in ([a_bytes[i] for i in a], [piece(i) for i in b])]
        starts = [np.r_[0, e[:-1]] for e in ends]
        links = [
            (a[i], b[j]) for i in range(len(a)) for j in range(len(b))
            if starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i]
        ]
        groups, at = [], 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            groups.append([[x[i] for i in range(len(x)) if at < e[i] <= end] for x, e in zip((a, b), ends, strict=True)])
            at = end
        count.update(links)
        rows.append((len(a), len(b), groups, links))
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for row in rows:
        if row is None:
            out.append((0, 0, 0, 0, 0, 0, 0, "", ""))
            continue
        n_a, n_b, groups, links = row
        written = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append((
            n_a, n_b, len(groups), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
            sum(len(x) * len(y) for x, y in groups), hashlib.sha256(written.encode()).hexdigest(), written,
        ))
    return out


TEXTS = [
    None, "", "  two  blanks ", "a\n b \nc\t d", "<|endoftext|> <s> </s>", "▁ is a blank", "é ü ﬁ 漢字漢字 　x\xa0y z", "x" * 700,
    "\n", " ", "  ", "the\u0085 x", "\x1c x", "🙂🙂 ok", " lead", "trail ", "The same text.", "The same text.", "don't 'tis 12 345",
]


def _alignment_rows(df):
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "n_group_links", "groups_sha256", "groups"]
    return [tuple(r[c] for c in columns) for r in df.collect()]


@pytest.mark.parametrize("bounds", [{}, {"CHUNK_ROWS": 2, "_MEMORY": 5, "_STEP": 20}])
def test_alignment_odd_rows(spark, monkeypatch, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(alignment, name, value)
    # Ids that repeat or are null, and columns named like the new ones.
    rows = [(None if i % 5 == 0 else i // 2, t, 7, "x") for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a int, chunk string").repartition(3)
    found = alignment.align_documents(docs, ONE, OTHER, with_groups=True)
    key = lambda r: tuple(map(str, r))
    got = sorted(((r["doc_id"], *x) for r, x in zip(found.collect(), _alignment_rows(found), strict=True)), key=key)
    assert got == sorted(((r[0], *x) for r, x in zip(rows, _aligned(TEXTS), strict=True)), key=key)
    assert alignment.align_documents(docs.limit(0), ONE, OTHER).count() == 0


def test_alignment_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").filter("length(text) < 1500").collect()
    some = spark.createDataFrame(docs)
    want = dict(zip([r["doc_id"] for r in docs], _aligned([r["text"] for r in docs]), strict=True))
    got = alignment.align_documents(some, ONE, OTHER, with_groups=True)
    assert dict(zip([r["doc_id"] for r in got.collect()], _alignment_rows(got), strict=True)) == want
    whole = registry.op12_tokenizer_alignment(spark, sf_dir).collect()
    assert len(whole) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    alone = {i: x for i, x in want.items() if x[-1]}
    assert all(r["n_links"] == alone[r["doc_id"]][3] for r in whole if r["doc_id"] in alone)


def test_link_counts(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "a")], "doc_id long, text string")
    counts = alignment.link_counts(docs, ONE, OTHER).collect()
    assert sorted(r["count"] for r in counts) == [1, 3] and all(r["best"] for r in counts)


# Vectors.


def _vector_classes(rows, similarity=0.95):
    good = [
        v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows
    ]
    n = len(rows)
    linked = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            if i != j and good[i] and good[j] and len(rows[i][1]) == len(rows[j][1]):
                x, y = (np.array(rows[k][1]) / max(map(abs, rows[k][1])) for k in (i, j))
                linked[i, j] = x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= similarity
    label = embedding_dedup.joined_rows(n, *np.nonzero(linked))
    least = {}
    for (id_, _), of in zip(rows, label, strict=True):
        if id_ is not None:
            least[of] = min(least.get(of, id_), id_)
    return sorted(((rows[i][0], int(linked[i].sum()), least.get(label[i])) for i in range(n)), key=str)


def _found(df, **options):
    found = embedding_dedup.near_duplicate_vectors(df, **options)
    assert found.columns == ["vec_id", "n_links", "component_id"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_vectors_odd_rows(spark):
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.1]), (4, [0.0, 0.0]), (5, None), (6, []), (7, [math.nan, 1.0]),
        (8, [None, 1.0]), (9, [math.inf, 1.0]), (10, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (2, [2.0, 0.0]),
        (11, [-1.0, 0.0]), (12, [1e300, 1e299]), (None, [0.0, 1.0]), (2, [0.0, -1.0]),
    ]
    df = spark.createDataFrame([(*r, 3, "x") for r in rows], "vec_id long, embedding array<double>, n_links int, node string")
    assert _found(df) == _vector_classes(rows)
    assert _found(df.limit(0)) == []


@pytest.mark.parametrize("options", [{}, {"block": 16, "window": 8}])
def test_vectors_in_clouds(spark, options):
    rng = np.random.default_rng(1)

    def cloud(n, noise):
        centre = rng.standard_normal(16)
        return centre / np.linalg.norm(centre) + noise * rng.standard_normal((n, 16)) / 4

    # Lone vectors, clouds whose members are all linked, mostly linked and hardly linked, and copies.
    parts = [rng.standard_normal((100, 16)), cloud(90, 0.15), cloud(60, 0.3), cloud(50, 0.45)]
    x = np.concatenate([*parts, np.repeat(rng.standard_normal((1, 16)), 30, axis=0)]).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    assert _found(df, **options) == _vector_classes(rows)


def test_vector_recall_of_lone_pairs(spark):
    """Pairs at just 0.95 among many others; windows and passes as they follow from the rows."""
    rng = np.random.default_rng(2)
    x = rng.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    aside = rng.standard_normal((400, 64))
    aside -= (aside * x[:400]).sum(axis=1, keepdims=True) * x[:400]
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    near = 0.9501 * x[:400] + math.sqrt(1 - 0.9501**2) * aside
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([x, near]))]
    got = _found(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    linked = [r for r in got if r[1]]
    assert len(linked) >= 0.98 * 800 and all(r[1] == 1 and r[2] < 400 for r in linked)
    assert embedding_dedup.passes_needed(60) == 1 and embedding_dedup.passes_needed(10**9) < 100


def test_vector_query(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = registry.op13_embedding_dedup(spark, sf_dir).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str) == _vector_classes(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
