"""Golden rows for the parsers (one per rule of the stream format), list
responses, labels, bytes."""

from pyspark.sql import functions as F

from memtables.functions.json import labels_from_json, labels_text
from memtables.functions.text import base64_flat, valid_utf8
from memtables.operators import parse as PZ
from memtables.operators.retrieval import parse_space_keys

B = '{"resultSetBoundary":{"resultSetId":"rs1"}}'
I = ('{"retrievedItem":{"chunk":{"chunk":{"chunkId":"c1","chunkText":"hello","memoryId":"m1"},'
     '"relevanceScore":0.9,"memoryIndex":0}}}')
M = '{"memoryDefinition":{"memoryId":"m1"}}'


def _parse(spark, bodies):
    df = spark.createDataFrame(list(enumerate(bodies)), "body_id long, body string")
    rows = PZ.parse_retrieval_stream(df).orderBy("body_id", "line_no").collect()
    return [r.asDict() for r in rows]


def _collect(spark, bodies):
    df = spark.createDataFrame(list(enumerate(bodies)), "body_id long, body string")
    rs = PZ.collect_result_set(df).orderBy("body_id").collect()
    return [r.asDict(recursive=True) for r in rs]


def test_plain_and_crlf(spark):
    for sep in ("\n", "\r\n"):
        rows = _parse(spark, [sep.join([B, M, I])])
        assert [r["kind"] for r in rows] == ["boundary", "memory", "item"]
        assert rows[2]["chunk_id"] == "c1" and rows[2]["relevance_score"] == 0.9
        assert rows[2]["memory_index"] == 0 and rows[0]["result_set_id"] == "rs1"


def test_sse_prefix_and_event_lines(spark):
    body = "\n".join(["event: message", "data: " + B, "", "data:" + I, "data: event: x", "event:"])
    rows = _parse(spark, [body])
    assert [r["kind"] for r in rows] == ["boundary", "item"]


def test_broken_json_and_non_objects_skipped(spark):
    body = "\n".join([B, '{"retrievedItem":', "[1,2]", "42", '"s"', "not json", '{"unknown":{}}', I])
    assert [r["kind"] for r in _parse(spark, [body])] == ["boundary", "item"]


def test_trailing_garbage_is_not_json(spark):
    assert _parse(spark, [I + " tail"]) == []


def test_several_keys_first_in_order_wins(spark):
    line = '{"retrievedItem":{},"abstractReply":{"t":1},"resultSetBoundary":{"resultSetId":"x"}}'
    rows = _parse(spark, [line])
    assert len(rows) == 1 and rows[0]["kind"] == "boundary" and rows[0]["result_set_id"] == "x"


def test_null_member_skips_line(spark):
    body = "\n".join(['{"resultSetBoundary":null}', '{"memoryDefinition":null}',
                      '{"retrievedItem":{"chunk":null}}', '{"retrievedItem":{"chunk":{"chunk":5}}}'])
    assert _parse(spark, [body]) == []


def test_empty_item_kept_with_empty_strings(spark):
    rows = _parse(spark, ['{"retrievedItem":{}}'])
    assert rows[0]["chunk_id"] == "" and rows[0]["chunk_text"] == "" and rows[0]["memory_id"] == ""
    assert rows[0]["relevance_score"] is None and rows[0]["memory_index"] is None


def test_collect_boundaries_abstract_and_totals(spark):
    b2 = '{"resultSetBoundary":{"resultSetId":"rs2"}}'
    no_id = '{"resultSetBoundary":{}}'
    a1, a2 = '{"abstractReply":{"text":"a"}}', '{"abstractReply":{"text":"b"}}'
    item2 = '{"retrievedItem":{"chunk":{"chunk":{"chunkId":"c2"}}}}'
    out = _collect(spark, ["\n".join([B, a1, I, b2, no_id, M, item2, a2]), "", "garbage"])
    first = out[0]
    assert first["result_set_id"] == "rs2"
    assert [r["chunk_id"] for r in first["results"]] == ["c1", "c2"]
    assert first["results"][1]["relevance_score"] is None
    assert first["total_results"] == 2 and len(first["memories"]) == 1
    assert '"b"' in first["abstract_reply"]
    assert out[1]["result_set_id"] == "" and out[1]["total_results"] == 0
    assert out[2]["results"] == [] and out[2]["abstract_reply"] is None


def test_list_response_shapes(spark):
    bodies = ['[{"a":1},2,{"a":3}]', '{"spaces":[{"a":1}]}', '{"other":[{"a":1}]}', "7",
              '[1,"x",null]', '{"spaces":{"a":1}}', "not json"]
    df = spark.createDataFrame(list(enumerate(bodies)), "body_id long, body string")
    rows = PZ.normalize_list_response(df, "spaces").orderBy("body_id", "position").collect()
    assert [(r.body_id, r.position) for r in rows] == [(0, 1), (0, 3), (1, 1)]


def test_space_keys(spark):
    df = spark.createDataFrame([(1, "id1, ,id2,"), (2, " , "), (3, "\tx\t,x"), (4, None)],
                               "query_id long, space_ids string")
    rows = {r.query_id: r for r in parse_space_keys(df).collect()}
    assert rows[1].space_keys == ["id1", "id2"] and rows[1].success
    assert rows[2].space_keys == [] and not rows[2].success and rows[2].error
    assert rows[3].space_keys == ["x", "x"]
    assert not rows[4].success


def test_labels(spark):
    cases = [None, "", "null", "{}", '{"a":null,"b":"x"}', '{"n": 2024, "f": 1.50}', '{"t":true}',
             '{"o":{"x":1}}', '{"arr":[1]}', "[1]", '"s"', "{bad"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, j string")
    got = {r.i: r for r in df.select("i", labels_from_json(F.col("j")).alias("p"))
           .select("i", labels_text(F.col("p.labels")).alias("t"), "p.error").collect()}
    assert got[0].t is None and got[0].error is None
    assert got[1].t is None and got[2].t is None and got[2].error is None
    assert got[3].t == "" and got[3].error is None
    assert got[4].t == "b=x"
    # numbers are normalised by the JSON reader (1.50 -> 1.5): documented difference
    assert got[5].t == "f=1.5;n=2024"
    assert got[6].t == "t=true"
    for i in (7, 8, 9, 10, 11):
        assert got[i].error is not None and got[i].t is None, i


def test_bytes(spark):
    df = spark.createDataFrame([(bytearray(b"caf\xc3\xa9"),), (bytearray(b"a\xffb"),), (bytearray(300),)],
                               "b binary")
    rows = df.select(valid_utf8(F.col("b")).alias("s"), base64_flat(F.col("b")).alias("e")).collect()
    assert rows[0].s == "café"
    assert rows[1].s == "a�b"
    assert len(rows[2].e) == 400 and "\n" not in rows[2].e
