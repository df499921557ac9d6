"""Ordinary bad data: mixed and missing vectors, string ids, late and repeated memories, trailing JSON."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from memtables.functions.json import labels_from_json, strict_parse_json
from memtables.operators import catalog as C
from memtables.operators import memories as M
from memtables.operators import postprocess as P
from memtables.operators import retrieval
from memtables.operators.chunking import chunk_by_config
from memtables.operators.retrieval import retrieve_topk
from memtables.sources import tables as T
from memtables.sources.ingest import metadata_of
from memtables.schema import MSG_STILL_PROCESSING
from memtables.streaming.indexing import indexing_freshness, latest_status, run_to_completion


def test_retrieval_mixed_vectors_and_string_ids(spark):
    chunks = spark.createDataFrame(
        [("c1", "m-1", "a", [1.0, 0.0]), ("c2", "m-2", "a", [0.0, 1.0]), ("c3", "m-3", "a", [1.0, 0.0, 0.0]), ("c4", "m-4", "a", None),
         ("c5", "m-5", "a", []), ("c6", "m-6", "a", [0.0, 0.0]), ("d1", "m-7", "b", None), ("d2", "m-8", "c", [1.0, 1.0, 1.0])],
        "chunk_id string, memory_id string, space_id string, embedding array<float>")
    requests = spark.createDataFrame(
        [("q1", [1.0, 0.5], "a,b"), ("q2", [1.0, 0.2, 0.0], "a,c"), ("q3", None, "a"), ("q4", [0.0, 0.0], "a"), ("q5", [1.0], "a,b,c")],
        "query_id string, query_vector array<double>, space_ids string")
    want = [("q1", 1, "c1", "m-1"), ("q1", 2, "c2", "m-2"), ("q2", 1, "c3", "m-3"), ("q2", 2, "d2", "m-8")]
    for method in ("auto", "blocks", "tiled"):
        got = retrieve_topk(requests, chunks, method=method).select("query_id", "rank", "chunk_id", "memory_id")
        assert sorted(map(tuple, got.collect())) == want, method


@pytest.mark.parametrize("text,ok", [
    ('{"a":1}', True), (' {"a":{"b":[1,2]}} \n', True), ('{"a":1}{"b":2}', False), ('{"a":1} junk}', False), ('{"a":1},{"b":2}', False),
    ('{"a":1}],[{"b":2}', False), ("[1,2]", True), ("[1],[2]", False), ('"x"', True), ('"x","y"', False), ("12", True), ("null", True), ("{", False)])
def test_one_json_value_only(spark, text, ok):
    row = spark.createDataFrame([(text,)], "t string").select(strict_parse_json(F.col("t")).isNotNull().alias("v")).first()
    assert row.v == ok


def test_blank_metadata_and_labels_mean_none(spark):
    df = spark.createDataFrame([("\n",), (" null\n",), ("\t ",)], "t string")
    for r in df.select(metadata_of(F.col("t")).alias("m"), labels_from_json(F.col("t")).alias("l")).collect():
        assert r.m.error is None and r.l.error is None and r.l.labels is None


def test_memory_of_an_unknown_space_is_chunked(spark):
    spaces = T.spaces(spark, "/root/testdata/sf0.001").limit(1)
    got = chunk_by_config(spark.createDataFrame([(1, "nowhere", "some text")], "memory_id long, space_id string, original_content string"), spaces)
    assert got.count() == 1


def test_late_and_replayed_memories_are_indexed_once(spark, tmp_path):
    source = tmp_path / "in"
    schema = "memory_id long, space_id string, original_content string, created_at timestamp"
    day = lambda m: dt.datetime(2024, m, 1)
    for k, rows in enumerate([[(1, "s", "june one", day(6)), (2, "s", "june two", day(6))], [(3, "s", "january", day(1)), (3, "s", "january", day(1))],
                              [(1, "s", "june one", day(6)), (4, "s", "may", day(5))]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
    child, out = run_to_completion(spark, lambda s: s.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source)))
    status = latest_status(child, out)
    assert sorted(r.memory_id for r in status.collect()) == [1, 2, 3, 4]
    vectors = child.read.parquet(f"{out}/vectors")
    assert {r.memory_id for r in vectors.collect()} == {1, 2, 3, 4} and vectors.count() == 4


def test_stream_reads_a_folder_of_part_files(spark, tmp_path):
    from memtables.streaming.indexing import documents_stream
    sf = "/root/testdata/sf0.001"
    spark.read.parquet(f"{sf}/documents.parquet").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{sf}/events.parquet").write.parquet(str(tmp_path / "events.parquet"))
    counts = []
    for path in (sf, str(tmp_path)):
        child, out = run_to_completion(spark, lambda s, p=path: documents_stream(s, p))
        counts.append(child.read.parquet(f"{out}/status").count())
    assert counts[0] == counts[1] > 0


def test_pages_with_null_creation_times_and_string_ids(spark):
    day = lambda n: dt.datetime(2024, 1, n)
    rows = [("b", None), ("a", None), ("x|y", day(1)), ("d", day(1)), ("c", day(2))]
    mem = spark.createDataFrame([(m, "s", None, t) for m, t in rows],
                                "memory_id string, space_id string, processing_status string, created_at timestamp_ntz")
    seen, token = [], None
    for _ in rows:
        page = M.page_memories(mem, "s", page_size=2, next_token=token).orderBy("position").collect()
        seen += [r.memory_id for r in page]
        token = page[0].next_token
        if token is None:
            break
    assert seen == ["a", "b", "d", "x|y", "c"]
    everything = M.page_all(mem, page_size=2, partitions=3).orderBy("position").collect()
    assert [r.memory_id for r in everything] == seen


def test_full_pages_know_whether_there_is_a_next_one(spark):
    mem = spark.range(1001).select(F.col("id").alias("memory_id"), F.lit("s").alias("space_id"), F.lit(None).cast("string").alias("processing_status"),
                                   F.lit(None).cast("timestamp_ntz").alias("created_at"))
    for n, last in ((1000, False), (1001, True)):
        page = M.page_memories(mem.where(F.col("memory_id") < n), "s", page_size=1000).collect()
        assert len(page) == 1000 and (page[0].next_token is not None) == last


def test_malformed_token_is_an_error_row_beside_good_requests(spark):
    mem = T.memories(spark, SF_SMALL)
    junk = ["a", "????", "AAAA", "MjAyNC0wMS0wMXw=", "fHg="]          # the last two: no id; an id that is no number
    req = spark.createDataFrame([(f"bad{i}", "src1", 3, t, None) for i, t in enumerate(junk)] + [("good", "src1", 3, "", None)],
                                "request_id string, space_id string, page_size int, next_token string, status string")
    for content in (False, True):
        got = M.list_memories(mem, req, include_content=content).collect()
        assert sorted(r.request_id for r in got if not r.success) == [f"bad{i}" for i in range(len(junk))]
        good = [r for r in got if r.success]
        assert len(good) == 3 and (not content or all(r.original_content is not None for r in good))


def test_paging_does_not_rest_on_exchange_reuse(spark):
    mem = T.memories(spark, SF_SMALL)
    want = sorted((r.space_id, r.memory_id, r.position) for r in M.page_all(mem, 7, 5).collect())
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        assert sorted((r.space_id, r.memory_id, r.position) for r in M.page_all(mem, 7, 5).collect()) == want
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    spaces = {}
    for s, _, p in want:
        spaces.setdefault(s, []).append(p)
    assert all(sorted(p) == list(range(1, len(p) + 1)) for p in spaces.values())


def test_unusable_requests_are_error_rows(spark):
    req = spark.createDataFrame(
        [(1, [1.0, 0.0], "a", None), (2, [1.0], " , ", None), (3, None, "a", ""), (4, [0.0, 0.0], "a", None), (5, [1.0, 0.0], "a", "nope"), (6, [], "a", "jaccard")],
        "query_id long, query_vector array<double>, space_ids string, reranker_id string")
    for c, t in (("query_text", "string"), ("max_results", "int"), ("relevance_threshold", "double"), ("llm_id", "string"),
                 ("llm_temperature", "double"), ("chronological_resort", "boolean")):
        req = req.withColumn(c, F.lit(None).cast(t))
    got = {r.query_id: r for r in P.retrieval_outcomes(req).collect()}
    assert [got[i].success for i in range(1, 7)] == [True] + [False] * 5
    assert got[5].error == "Unknown reranker: nope"
    chunks = spark.createDataFrame([("c", 1, "a", [1.0, 0.0])], "chunk_id string, memory_id long, space_id string, embedding array<float>")
    texts = spark.createDataFrame([("c", "Hello there. Bye.")], "chunk_id string, chunk_text string")
    mem = spark.createDataFrame([(1, "a", "PENDING", dt.datetime(2024, 1, 1))], "memory_id long, space_id string, processing_status string, created_at timestamp_ntz")
    res = P.retrieve_postprocessed(req, chunks, texts, mem)
    assert [r.query_id for r in res.collect()] == [1]
    sets = {r.query_id: r for r in P.result_sets(res, req.withColumn("llm_id", F.lit("any")), mem, indexing_freshness(mem)).collect()}
    assert len(sets) == 6 and sets[1].total_results == 1 and sets[1].abstract_reply == "Hello there. Bye."
    assert sets[4].abstract_reply is None and sets[4].message == MSG_STILL_PROCESSING and sets[5].error


@pytest.mark.parametrize("blocks", [4, 40])
def test_query_blocks_give_the_same_rows(spark, monkeypatch, blocks):
    """In few and in many stored blocks."""
    req, vec = T.retrieval_requests(spark, SF_SMALL), T.chunk_vectors(spark, SF_SMALL)
    rows = lambda **kw: sorted(map(tuple, retrieve_topk(req, vec, **kw).collect()))
    want = rows()
    n = retrieval._query_rows(req, 5, False).count() * (8 * 64 + 96)
    monkeypatch.setattr(retrieval, "QUERY_BLOCK_BYTES", n // blocks)
    assert rows() == want
    everywhere = [sorted(map(tuple, retrieve_topk(req, vec, method=m, all_spaces=True).collect())) for m in ("auto", "tiled")]
    assert everywhere[0] == everywhere[1] and {r[4] for r in everywhere[0]} != {"*"}


def test_patches_of_one_space_apply_in_order(spark):
    spaces = T.spaces(spark, SF_SMALL)
    n = 300
    patches = [("src1", i, f"n{i}" if i % 3 == 0 else None, None, None, f'{{"k{i}":"{i}"}}') for i in range(n)]
    patches += [("src1", n, None, True, '{"only":"one"}', None), ("src1", n + 1, "bad", None, "[1]", None), ("src1", n + 2, None, None, None, '{"two":"2"}')]
    df = spark.createDataFrame(patches[::-1], "space_id string, seq int, name string, public_read boolean, replace_labels_json string, merge_labels_json string")
    rec, snap = C.update_spaces(spaces, df)
    got = {r.seq: r for r in rec.collect()}
    assert len(got) == n + 3 and not got[n + 1].success
    assert len(got[n - 1].labels) == n + 1 and got[n - 1].name == "n297" and got[n].labels == {"only": "one"}
    one = snap.where("space_id = 'src1'").collect()
    assert len(one) == 1 and one[0].name == "n297" and one[0].public_read and one[0].labels == {"only": "one", "two": "2"}
    assert snap.count() == spaces.count() and snap.columns == spaces.columns


def test_ids_of_different_keys_differ(spark):
    from memtables.sources.ingest import memory_id_of
    keys = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("x", None), ("-", "x"), ("x", "-"), ("", "x"), ("x", ""), (None, None), ("1:a", "b"), ("1", "a:b"), ("", "")]
    rows = spark.createDataFrame(keys, "s string, r string").select(memory_id_of(F.col("s"), F.col("r")).alias("id")).collect()
    assert len({r.id for r in rows}) == len(keys) and all(len(r.id) == 64 for r in rows)
