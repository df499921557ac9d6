"""Registered parser queries (ops 8, 9, 10).

The response bodies are built in Spark from the ``embeddings`` and
``documents`` tables, one bounded body per row, each body exercising one rule
of the stream format (CRLF, SSE ``data:`` / ``event:`` lines, broken JSON,
several keys in one line, null members, empty items, boundaries without id,
repeated boundaries, items without score).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from memtables.operators import parse as PZ
from memtables.plans.registry import query
from memtables.sources import tables as T


def _s(c: Column) -> Column:
    return c.cast("string")


def result_stream_bodies(spark: SparkSession, d: str) -> DataFrame:
    e = T.read(spark, d, "embeddings").select("vec_id", "label")
    i = _s(F.col("vec_id"))
    mem = _s(F.col("label") * 10 + F.pmod(F.col("vec_id"), F.lit(7)))
    score = F.concat(F.lit("0."), F.lpad(_s(F.pmod(F.col("vec_id"), F.lit(1000))), 3, "0"))
    B = F.concat(F.lit('{"resultSetBoundary":{"resultSetId":"rs-'), i, F.lit('"}}'))
    M = F.concat(F.lit('{"memoryDefinition":{"memoryId":"'), mem, F.lit('","spaceId":"label-'),
                 _s(F.col("label")), F.lit('"}}'))
    I = F.concat(F.lit('{"retrievedItem":{"chunk":{"chunk":{"chunkId":"'), i,
                 F.lit('","chunkText":"text '), i, F.lit('","memoryId":"'), mem,
                 F.lit('"},"relevanceScore":'), score, F.lit(',"memoryIndex":0}}}'))
    A = F.concat(F.lit('{"abstractReply":{"text":"summary '), i, F.lit('"}}'))
    A2 = F.concat(F.lit('{"abstractReply":{"text":"final '), i, F.lit('"}}'))
    B2 = F.concat(F.lit('{"resultSetBoundary":{"resultSetId":"rs2-'), i, F.lit('"}}'))
    multi = F.concat(F.lit('{"retrievedItem":{"chunk":{"chunk":{"chunkId":"x'), i,
                     F.lit('"}}},"resultSetBoundary":{"resultSetId":"multi-'), i, F.lit('"}}'))
    bare = F.concat(F.lit('{"retrievedItem":{"chunk":{"chunk":{"chunkId":"'), i,
                    F.lit('","chunkText":"t","memoryId":"'), mem, F.lit('"}}}}'))
    nl = F.lit("\n")
    v = F.pmod(F.col("vec_id"), F.lit(8))
    body = (
        F.when(v == 0, F.concat_ws("\n", B, M, I))
        .when(v == 1, F.concat_ws("\r\n", B, M, I))
        .when(v == 2, F.concat_ws("\n", F.lit("event: message"), F.concat(F.lit("data: "), B), F.lit(""),
                                  F.concat(F.lit("data: "), M), F.concat(F.lit("data:"), I),
                                  F.lit("data: event: x")))
        .when(v == 3, F.concat_ws("\n", B, F.lit('{"retrievedItem":'), F.lit("[1,2]"), F.lit("42"), I,
                                  F.lit("not json")))
        .when(v == 4, F.concat_ws("\n", B, multi, I))
        .when(v == 5, F.concat_ws("\n", B, F.lit('{"resultSetBoundary":null}'), F.lit('{"retrievedItem":{}}'),
                                  F.lit('{"memoryDefinition":null}'), I))
        .when(v == 6, F.concat_ws("\n", B, F.lit('{"resultSetBoundary":{}}'), A, I, A2))
        .otherwise(F.concat(B, nl, bare, nl, B2, nl)))
    return e.select(F.col("vec_id").alias("body_id"), body.alias("body"))


@query("parse_retrieval_stream")
def parse_retrieval_stream(spark: SparkSession, d: str) -> DataFrame:
    return PZ.parse_retrieval_stream(result_stream_bodies(spark, d))


@query("collect_result_set")
def collect_result_set(spark: SparkSession, d: str) -> DataFrame:
    rs = PZ.collect_result_set(result_stream_bodies(spark, d))
    return rs.select(
        "body_id", "result_set_id", "total_results",
        F.size("memories").cast("long").alias("total_memories"),
        F.array_join(F.transform("results", lambda x: x["chunk_id"]), ",").alias("chunk_ids"),
        F.array_join(F.transform("results", lambda x: F.coalesce(x["relevance_score"].cast("string"),
                                                                F.lit("-"))), ",").alias("scores"),
        "abstract_reply")


def list_bodies(spark: SparkSession, d: str) -> DataFrame:
    """One list response per memory, in five shapes by ``doc_id % 5``: bare
    array, keyed object, wrong key, scalar, array with non-objects."""
    m = T.memories(spark, d).select("memory_id", "processing_status")
    i = _s(F.col("memory_id"))
    st = F.coalesce("processing_status", F.lit("PENDING"))
    v = F.pmod(F.col("memory_id"), F.lit(5))
    body = (
        F.when(v == 0, F.concat(F.lit('[{"memoryId":"'), i, F.lit('"},7,{"memoryId":"'), i, F.lit('-b"}]')))
        .when(v == 1, F.concat(F.lit('{"memories":[{"memoryId":"'), i, F.lit('","status":"'), st,
                               F.lit('"}],"nextToken":null}')))
        .when(v == 2, F.concat(F.lit('{"items":[{"memoryId":"'), i, F.lit('"}]}')))
        .when(v == 3, F.lit("42"))
        .otherwise(F.concat(F.lit('[1,"x",null,{"memoryId":"'), i, F.lit('"}]'))))
    return m.select(F.col("memory_id").alias("body_id"), body.alias("body"))


@query("normalize_list_response")
def normalize_list_response(spark: SparkSession, d: str) -> DataFrame:
    rows = PZ.normalize_list_response(list_bodies(spark, d), "memories")
    return rows.select("body_id", "position",
                       F.try_variant_get("element", "$.memoryId", "string").alias("memory_id"),
                       F.to_json("element").alias("element"))
