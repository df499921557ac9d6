"""Exact top-k: both physical forms against a numpy brute force, on the
sf0.001 vectors and on a skewed layout where one space holds most chunks."""

import numpy as np
from pyspark.sql import functions as F

from memtables.operators import memories as M
from memtables.operators import postprocess as P
from memtables.operators import retrieval as R
from memtables.operators import sizing as SZ
from memtables.sources import tables as T

from conftest import SF_SMALL


def brute_force(req_pd, chunks_pd, k=5):
    out = set()
    cm = {r.chunk_id: (r.space_id, np.asarray(r.embedding, dtype=float)) for r in chunks_pd.itertuples()}
    for q in req_pd.itertuples():
        keys = [s.strip() for s in q.space_ids.split(",") if s.strip()]
        qv = np.asarray(q.query_vector, dtype=float)
        cands = []
        for cid, (sp, v) in cm.items():
            if sp in keys:
                s = round(float(qv @ v / (np.linalg.norm(qv) * np.linalg.norm(v))), 6)
                cands.append((-s, cid))
        for rank, (ns, cid) in enumerate(sorted(cands)[:k], start=1):
            out.add((q.query_id, rank, cid))
    return out


def _got(df):
    return {(r.query_id, r.rank, r.chunk_id) for r in df.select("query_id", "rank", "chunk_id").collect()}


def test_forms_equal_brute_force(spark):
    req = T.retrieval_requests(spark, SF_SMALL).where(F.col("query_id") < 60)
    cv = T.chunk_vectors(spark, SF_SMALL)
    expect = brute_force(req.toPandas(), cv.toPandas())
    assert _got(R.retrieve_topk(req, cv, method="blocks")) == expect
    assert _got(R.retrieve_topk(req, cv, method="tiled")) == expect
    # tiny tiles: every space is cut into many chunk tiles and query blocks
    assert _got(R.retrieve_topk(req, cv, method="tiled", max_tile_chunks=7, max_tile_queries=3)) == expect


def test_hot_space_is_split(spark):
    cv = T.chunk_vectors(spark, SF_SMALL).withColumn(
        "space_id", F.when(F.col("chunk_id") % 3 != 0, F.lit("label-1")).otherwise(F.col("space_id")))
    req = T.retrieval_requests(spark, SF_SMALL).where(F.col("query_id") < 40)
    expect = brute_force(req.toPandas(), cv.toPandas())
    assert _got(R.retrieve_topk(req, cv, method="tiled", max_tile_chunks=50)) == expect


def test_k_plus_one_extends_k(spark):
    cv = T.chunk_vectors(spark, SF_SMALL)
    r5 = _got(R.retrieve_topk(T.retrieval_requests(spark, SF_SMALL, max_results=5), cv))
    r6 = _got(R.retrieve_topk(T.retrieval_requests(spark, SF_SMALL, max_results=6), cv))
    assert r5 < r6 and all(x[1] <= 5 for x in r5)


def test_chain_options(spark):
    cv, ct, mem = T.chunk_vectors(spark, SF_SMALL), T.chunk_texts(spark, SF_SMALL), T.memories(spark, SF_SMALL)
    plain = R.retrieve_topk(T.retrieval_requests(spark, SF_SMALL), cv)
    chain_k = P.retrieve_postprocessed(T.retrieval_requests(spark, SF_SMALL), cv, ct, mem)
    assert _got(plain) == _got(chain_k)
    thr = P.retrieve_postprocessed(T.retrieval_requests(spark, SF_SMALL, relevance_threshold=0.3), cv, ct, mem)
    rows = thr.collect()
    assert all(r.relevance_score >= 0.3 for r in rows)
    assert {(r.query_id, r.chunk_id) for r in rows} <= {(q, c) for q, _, c in _got(plain)}
    # the flag alone turns the chain on; false keeps the order
    off = P.retrieve_postprocessed(T.retrieval_requests(spark, SF_SMALL, chronological_resort=False),
                                   cv, ct, mem)
    assert _got(off) == _got(plain)
    re = P.retrieve_postprocessed(T.retrieval_requests(spark, SF_SMALL, chronological_resort=True),
                                  cv, ct, mem).collect()
    by_q = {}
    for r in re:
        by_q.setdefault(r.query_id, []).append(r)
    for rs in by_q.values():
        rs.sort(key=lambda r: r.rank)
        keys = [(r.created_at, r.chunk_id) for r in rs]
        assert keys == sorted(keys)
        # memory_index: first appearance order
        seen = []
        for r in rs:
            if r.memory_id not in seen:
                seen.append(r.memory_id)
            assert r.memory_index == seen.index(r.memory_id)


def test_cosine_column_matches_kernel(spark):
    from memtables.functions.vectors import cosine
    req = T.retrieval_requests(spark, SF_SMALL).where(F.col("query_id") < 30)
    cv = T.chunk_vectors(spark, SF_SMALL)
    top = R.retrieve_topk(req, cv, method="blocks")
    j = (top.join(req.select("query_id", "query_vector"), "query_id")
         .join(cv.select("chunk_id", "embedding"), "chunk_id")
         .select("score", F.round(cosine(F.col("query_vector"), F.col("embedding")), 6).alias("c")))
    assert j.count() > 0 and j.where(F.abs(F.col("score") - F.col("c")) > 1e-6).count() == 0


def test_semi_join_reduction_gives_same_chain(spark, monkeypatch):
    cv, ct, mem = T.chunk_vectors(spark, SF_SMALL), T.chunk_texts(spark, SF_SMALL), T.memories(spark, SF_SMALL)
    req = T.retrieval_requests(spark, SF_SMALL, reranker_id="jaccard", chronological_resort=True)
    cols = ["query_id", "rank", "chunk_id", "relevance_score", "memory_index", "total_results"]
    plain = {tuple(r) for r in P.retrieve_postprocessed(req, cv, ct, mem).select(*cols).collect()}
    defs = {tuple(r) for r in R.fetch_memory_definitions(
        P.retrieve_postprocessed(req, cv, ct, mem), mem).collect()}
    ids = mem.select("memory_id").where(F.col("memory_id") % 7 == 0)   # deterministic request set
    gets = {(r.memory_id, r.success, r.processing_status) for r in M.get_memories(ids, mem).collect()}
    monkeypatch.setattr(SZ, "SEMI_JOIN_REDUCTION_BYTES", -1)
    reduced = P.retrieve_postprocessed(req, cv, ct, mem)
    plan = reduced._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in reduced.select(*cols).collect()} == plain
    assert "LeftSemi" in plan
    assert {tuple(r) for r in R.fetch_memory_definitions(reduced, mem).collect()} == defs
    assert {(r.memory_id, r.success, r.processing_status) for r in M.get_memories(ids, mem).collect()} == gets


def test_result_sets_envelope(spark):
    cv, ct, mem = T.chunk_vectors(spark, SF_SMALL), T.chunk_texts(spark, SF_SMALL), T.memories(spark, SF_SMALL)
    for ids_as_text in (False, True):
        cvx = cv.withColumn("chunk_id", F.col("chunk_id").cast("string")) if ids_as_text else cv
        ctx = ct.withColumn("chunk_id", F.col("chunk_id").cast("string")) if ids_as_text else ct
        req = T.retrieval_requests(spark, SF_SMALL, relevance_threshold=0.5).where(F.col("query_id") < 40)
        res = P.retrieve_postprocessed(req, cvx, ctx, mem)
        rs = {r.query_id: r for r in P.result_sets(res, req, mem).collect()}
        assert len(rs) == 40
        for q, r in rs.items():
            assert r.total_results == len(r.results) <= 5
            assert [x.memory_index for x in r.memories] == list(range(len(r.memories)))
            assert {x.memory_id for x in r.results} == {m.memory_id for m in r.memories}
            assert all(x.relevance_score >= 0.5 for x in r.results)


def test_reply_takes_the_central_sentences(spark):
    from memtables.operators.summary import summaries
    first = "Nothing of note stands here."
    core = "The red fox and the grey wolf hunt at night."
    also = "A grey wolf and a red fox hunt."
    rows = [(1, 1, f"{first} {core}\n{also}"), (1, 2, f"{core} !! Odd."), (2, 1, None), (2, 2, ""), (3, 1, "..."), (4, 1, "word " * 200 + ". Short."),
            (5, 1, "a b. c d"), (5, 2, "c d")]
    df = spark.createDataFrame(rows, "query_id long, rank int, chunk_text string")
    got = {r.query_id: r.abstract_reply for r in summaries(df, chars=80).collect()}
    assert got[1] == f"{core} {also}" and set(got) == {1, 4, 5}     # not each chunk's first sentence, a repeated one once
    assert got[5] == "a b. c d" and len(got[4]) <= 80
    assert {r.query_id: r.abstract_reply for r in summaries(df, chars=10).where("query_id = 1").collect()} == {1: core[:10]}
    assert summaries(df.limit(0)).count() == 0
    plan = summaries(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def _nodes(plan):
    yield plan
    for i in range(plan.children().size()):
        yield from _nodes(plan.children().apply(i))


def test_texts_stay_out_of_the_windows(spark):
    from memtables.operators.summary import summaries
    cv, ct, mem = T.chunk_vectors(spark, SF_SMALL), T.chunk_texts(spark, SF_SMALL), T.memories(spark, SF_SMALL)
    res = P.retrieve_postprocessed(T.retrieval_requests(spark, SF_SMALL, relevance_threshold=0.5), cv, ct, mem)
    windows = [n for n in _nodes(res._jdf.queryExecution().optimizedPlan()) if n.nodeName() == "Window"]
    assert windows and not any("chunk_text" in w.output().mkString(",") for w in windows)
    # the reply's words are counted in the request's row, not as rows of their own
    names = {n.nodeName() for n in _nodes(summaries(res)._jdf.queryExecution().optimizedPlan())}
    assert "Generate" not in names
    # the texts of a request are gathered once, for the results and the reply
    req = T.retrieval_requests(spark, SF_SMALL, relevance_threshold=0.5, llm_id="any")
    for df in (P.abstract_context(res), P.result_sets(res, req, mem)):
        gathered = [n for n in _nodes(df._jdf.queryExecution().optimizedPlan())
                    if n.nodeName() == "Aggregate" and "chunk_text" in n.expressions().mkString(",")]
        assert len(gathered) == 1


def test_copies_of_a_chunk_keep_their_places(spark):
    """A chunk id with several texts: each is a result of its own, scored by its own text."""
    e = [1.0, 0.0]
    cv = spark.createDataFrame([(1, 7, "s", e), (2, 7, "s", e)], "chunk_id long, memory_id long, space_id string, embedding array<float>")
    ct = spark.createDataFrame([(1, "red fox"), (1, "grey wolf"), (1, "grey wolf"), (3, "fox")], "chunk_id long, chunk_text string")
    mem = spark.createDataFrame([(7, None)], "memory_id long, created_at timestamp_ntz")
    req = spark.createDataFrame([(5, e, "red fox", "s", 3, None, "jaccard", None, None, None)],
                                "query_id long, query_vector array<float>, query_text string, space_ids string, max_results int, "
                                "relevance_threshold double, reranker_id string, llm_id string, llm_temperature double, chronological_resort boolean")
    got = [(r.rank, r.chunk_id, r.relevance_score, r.chunk_text, r.total_results)
           for r in P.retrieve_postprocessed(req, cv, ct, mem).orderBy("rank").collect()]
    assert got == [(1, 1, 1.0, "red fox", 3), (2, 1, 0.0, "grey wolf", 3), (3, 1, 0.0, "grey wolf", 3)]


def _peak(call):
    import tracemalloc
    tracemalloc.start()
    try:
        call()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_worker_holds_little_beside_its_vectors():
    import pandas as pd
    import pyarrow as pa

    from memtables.operators.embedding import HASH_DIM, _unit_counts_udf
    n, d = 80_000, 64
    arr = pa.ListArray.from_arrays(np.arange(0, n * d + 1, d, dtype=np.int32), np.ones(n * d, np.float32))
    assert _peak(lambda: R._by_length(arr)) < 1.5 * n * d * 8
    assert R._HELD_BYTES + R.QUERY_BLOCK_BYTES <= 32 << 20
    buckets = pd.Series([np.arange(i % 50, dtype=np.int32) for i in range(10_000)])
    unit, dims = _unit_counts_udf().func, pd.Series([HASH_DIM] * len(buckets))
    assert _peak(lambda: unit(buckets, dims)) < 4 * len(buckets) * HASH_DIM * 4
    norms = [float(np.linalg.norm(v)) for v in unit(buckets, dims)]
    assert norms[0] == 0 and all(abs(x - 1) < 1e-6 for x in norms[1:50])


def test_candidates_do_not_grow_with_the_passes(spark, monkeypatch):
    """Many queries: at most k candidates for each query row, however many parts the chunk table has; the same results."""
    rng = np.random.default_rng(7)
    vec = rng.integers(-3, 4, (300, 6)).tolist()                # small whole numbers: zero vectors and ties
    chunks = [(f"c{i:03d}", i % 9, None if i % 50 == 49 else f"s{i % 7 % 3}", None if i % 41 == 40 else [float(x) for x in v[:6 - i % 2]])
              for i, v in enumerate(vec)] + [("c001", 1, "s1", [float(x) for x in vec[1][:5]])]
    spaces = ["s0", "s1, s2,,s1", "s2,s0", " , ", "nowhere"]
    reqs = [(i, None if i % 29 == 28 else [float(x) for x in v[:6 - i % 2]], spaces[i % 5], 1 + i % 5) for i, v in enumerate(vec[:60])]
    cv = spark.createDataFrame(chunks, "chunk_id string, memory_id long, space_id string, embedding array<float>").repartition(8)
    req = spark.createDataFrame(reqs, "query_id long, query_vector array<float>, space_ids string, max_results int")
    rows = lambda **kw: sorted(map(tuple, R.retrieve_topk(req, cv, **kw).collect()))
    want, everywhere = rows(), rows(all_spaces=True)
    assert want == rows(method="tiled") and everywhere == rows(method="tiled", all_spaces=True)
    monkeypatch.setattr(R, "_HELD_BYTES", 1 << 13)              # chunks in many blocks, few queries held at once
    assert rows() == want and rows(all_spaces=True) == everywhere
    queries = R._query_rows(req, 5, False)
    cands, k = R._blocks(queries, cv.withColumn("search_key", F.col("space_id")), R._candidates_schema(queries, cv))
    assert k == 5 and 0 < cands.count() <= queries.agg(F.sum("k")).first()[0]
    assert R.retrieve_topk(req, cv.limit(0)).count() == 0
