"""Periodic runs, centroid clustering and SentencePiece against brute force and the library."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from memtables.llm import bitplanes, queries, runs, sentence_pieces

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, r string, ids string, runs string, collapsed string, g long, w map<string,string>"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows, clashing extra columns."""
    period = " ".join(f"wort{i % 977} ünd\n" if i % 977 % 50 == 0 else f"wort{i % 977}" for i in range(60_000))
    texts = [None, "", " \t\n", period, "x" * 3_000_000, " " * 20_000, "a b " * 9, "a b " * 9, "😀 中文 ﬁ \x00 ▁▁ x", "ab" * 50_000]
    rows = [(None if i == 1 else i, t, "x", None, "y", "z", 1, {"k": "v"}) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, (None,) * 8], SCHEMA)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# -- runs ----------------------------------------------------------------------

def brute_runs(words, least=12):
    number = {}
    w = np.array([number.setdefault(x, len(number)) for x in words])
    found = []
    for q in range(1, len(w) // 2 + 1):
        same = np.concatenate([[0], (w[:-q] == w[q:]).astype(int), [0]])
        edge = np.diff(same)
        for s, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            n = e - s + q
            if n >= max(least, 2 * q) and not any((w[s:s + n - p] == w[s + p:s + n]).all() for p in range(1, q)):
                found.append((s, n, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_planted(doc_id, words):
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def brute_op11(doc_id, text):
    words = brute_planted(doc_id, words_of(text))
    found = brute_runs(words)
    drop = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    milli = 1000 * best[1] // best[2] if found else None
    return (doc_id, len(found), *best, milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)),
            sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=7), st.integers(1, 6)), max_size=10), st.sampled_from([2, 3, 7, 12]))
def test_runs_of_any_words(blocks, least):
    words = [str(c).encode() for block, times in blocks for c in block * times]
    assert runs.word_runs(words, least) == brute_runs(words, least)


def test_runs_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {tuple(r) for r in queries.op11_runs(spark, SF).collect()}
    assert got == {brute_op11(r.doc_id, r.text) for r in docs}
    assert sum(r[1] for r in got) > 20


def test_runs_edges(spark, odd):
    for df in (odd, odd.limit(0)):
        out = df.withColumn("found", runs.periodic_runs(F.col("text")))
        assert out.columns == [*odd.columns, "found"] and out.count() == df.count()
    # the text of over 60,000 words is too long for brute force and has one run by construction
    long = {r.doc_id: r.found for r in odd.select("doc_id", runs.periodic_runs(F.col("text")).alias("found")).where("doc_id = 3").collect()}
    words = 60_000 + sum(i % 977 % 50 == 0 for i in range(60_000))
    assert [tuple(r) for r in long[3].runs] == [(0, words, 997)] and len(long[3].collapsed.split()) == 997
    short = odd.where("doc_id is null or doc_id <> 3").collect()
    got = queries.with_planted_periods(odd).where("doc_id is null or doc_id <> 3").select("doc_id", runs.periodic_runs(F.col("text")).alias("f")).collect()
    want = [(r.doc_id, brute_runs(brute_planted(r.doc_id, words_of(r.text)))) for r in short]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, [tuple(x) for x in r.f.runs]) for r in got), key=key) == sorted(want, key=key)


def test_collapsed_keeps_first_periods():
    words = [b"a", b"b"] * 8 + [b"c"]
    assert runs.word_runs(words) == [(0, 16, 2)]
    assert runs.collapsed(words, [(0, 16, 2)]) == [b"a", b"b", b"c"]


# -- centroids -----------------------------------------------------------------

def test_planes_give_exact_products():
    rng = np.random.default_rng(1)
    for most in (1, 2, 255, 256, 1 << 26):
        x, c = (rng.integers(-most, most, (n, 64)) for n in (70, 9))
        x[0], x[1] = -most, most - 1
        p, q = bitplanes.planes(x), bitplanes.planes(c)
        assert (bitplanes.dots(p, q) == x @ c.T).all() and (bitplanes.squares(p) == (x * x).sum(axis=1)).all()
        cluster, distance = bitplanes.nearest(p, c)
        d = ((x[:, None] - c) ** 2).sum(axis=2)
        assert (cluster == d.argmin(axis=1)).all() and (distance == d.min(axis=1)).all()
        sums = bitplanes.component_sums(p, cluster, len(c))
        assert all((sums[k] == x[cluster == k].sum(axis=0)).all() for k in range(len(c)))


def brute_clusters(rows, k=40, rounds=5):
    """rows: (id, vector) that take part; id -> (cluster, distance, cluster inertia, inertia, digest)."""
    x = np.array([np.floor(256 * np.array(v, float)).astype(int) for _, v in rows]).reshape(-1, 64)
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, hashlib.sha256(f"2:{rows[i][0]}".encode()).hexdigest(), list(rows[i][1])))
    c = x[order[:k]].copy()
    near = lambda: ((x[:, None] - c) ** 2).sum(axis=2)
    for _ in range(rounds):
        at = near().argmin(axis=1)
        for j in range(len(c)):
            if (at == j).any():
                c[j] = [sum(col) // len(col) for col in x[at == j].T.tolist()]
    d = near()
    at, best = d.argmin(axis=1), d.min(axis=1)
    return sorted(((i, int(a), int(b), int(best[at == a].sum()), int(best.sum()), sha(",".join(map(str, c[a])))) for (i, _), a, b in zip(rows, at, best)), key=str)


def test_centroids_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = queries.op12_centroids(spark, SF).collect()
    assert sorted(map(tuple, got), key=str) == brute_clusters(rows)


def test_centroid_edges(spark):
    rng = np.random.default_rng(2)
    good = [(i // 2 if i < 8 else i, [float(v) for v in rng.normal(size=64)]) for i in range(60)]
    good += [good[9]] * 3 + [(None, good[10][1]), (70, [0.0] * 64), (71, [1000.0, -1000.5] * 32)]
    bad = [(80, None), (81, []), (82, [1.0] * 63), (83, [1.0] * 65), (84, [None] + [1.0] * 63), (85, [float("nan")] * 64), (86, [float("inf")] + [0.0] * 63)]
    rows = [(i, v, "x", 1, 2, {"a": "b"}) for i, v in good + bad]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, planes string, of int, distance long, centroid map<string,string>").repartition(3)
    got = bitplanes.cluster(df, bitplanes.seed_key(F.col("vec_id")))
    got = got.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", bitplanes.digest(F.col("centroid")))
    assert sorted(map(tuple, got.collect()), key=str) == brute_clusters(good)
    assert bitplanes.cluster(df.limit(0), bitplanes.seed_key(F.col("vec_id"))).count() == 0
    few = bitplanes.cluster(df.where("vec_id = 70"), bitplanes.seed_key(F.col("vec_id"))).collect()
    assert [(r.cluster, r.distance, r.inertia) for r in few] == [(0, 0, 0)]


# -- SentencePiece ---------------------------------------------------------------

@pytest.fixture(scope="module")
def model():
    return sentence_pieces.read_model(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


_TEXT = st.lists(st.one_of(st.text(max_size=12), st.text("abcdefghin ", max_size=60), st.text(" ▁\n\t01", max_size=40),
                           st.sampled_from(["the ", "ing", "    ", " " * 33, "中国", "\U0001F917", "é", "aaaa", "</s>", "<0x41>", "\x00"])), max_size=12).map("".join)


@settings(max_examples=600, deadline=None)
@given(st.lists(_TEXT, min_size=1, max_size=5))
def test_pieces_of_any_text(model, library, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    got = [i.tolist() for i in sentence_pieces.Encoder(model).ids(texts)]
    assert got == library.encode(texts)
    assert [sentence_pieces.decoded(model, i) for i in got] == library.decode(got)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31_999)), max_size=12))
def test_decoding_any_ids(model, library, ids):
    assert sentence_pieces.decoded(model, ids) == library.decode(ids)


def test_one_by_one_equals_rounds(model):
    rng = np.random.default_rng(5)
    for _ in range(300):
        word = "▁" + "".join(rng.choice(list("etaoinshr"), rng.integers(1, 90)))
        sym = model.char[np.frombuffer(word.encode("utf-32-le"), "<u4")]
        whole, n = sentence_pieces.merge_words(model, sym, np.array([len(sym)]))
        assert whole.tolist() == sentence_pieces._one_by_one(model, sym).tolist() and n.tolist() == [len(whole)]


def test_cache_and_blocks_change_nothing(model, library, monkeypatch):
    rng = np.random.default_rng(6)
    texts = [" ".join("".join(rng.choice(list("abcdefg é"), rng.integers(1, 90))) for _ in range(30)) for _ in range(40)]
    for cache, block in ((0, 50), (20, 1000), (10 ** 6, 10 ** 6)):
        monkeypatch.setattr(sentence_pieces, "CACHE", cache)
        monkeypatch.setattr(sentence_pieces, "BLOCK", block)
        assert [i.tolist() for i in sentence_pieces.Encoder(model).ids(texts * 2)] == library.encode(texts * 2)


def _expected(library, rows):
    ids = {i: library.encode(t or "") for i, t in rows}
    return {(i, len(x), sha(",".join(map(str, x))), sha(library.decode(x))) for i, x in ids.items()}


def test_sentencepiece_query(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert {tuple(r) for r in queries.op13_sentencepiece(spark, SF).collect()} == _expected(library, docs)


def test_sentencepiece_edges(spark, odd, model, library):
    ids = sentence_pieces.encode(F.col("text"), model, spark)
    out = odd.withColumn("new_ids", ids).withColumn("back", sentence_pieces.decode(F.col("new_ids"), model, spark))
    assert out.columns == [*odd.columns, "new_ids", "back"] and out.limit(0).count() == 0 and odd.limit(0).select(ids).count() == 0
    for r in out.collect():
        assert r.new_ids == library.encode(r.text or "") and r.back == library.decode(r.new_ids)
    both = odd.select("text", sentence_pieces.encode_and_decode(F.col("text"), model, spark).alias("s")).collect()
    assert all(r.s.ids == library.encode(r.text or "") and r.s.decoded == library.decode(r.s.ids) for r in both)
    nulls = spark.createDataFrame([(None,), ([],), ([1, 2],)], "i array<int>").select(sentence_pieces.decode(F.col("i"), model, spark).alias("t"))
    assert [r.t for r in nulls.collect()] == ["", "", ""]


def test_other_models_are_refused():
    with pytest.raises(Exception):
        sentence_pieces.read_model(public_tokenizers.path("byte_bpe_50k.json"))
