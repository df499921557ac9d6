"""Registered retrieval queries (ops 21, 22, 30-33, 35-38)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memtables.operators import postprocess as P
from memtables.operators import retrieval as R
from memtables.plans.registry import query
from memtables.sources import tables as T


def _topk(spark: SparkSession, d: str, method: str) -> DataFrame:
    return R.retrieve_topk(T.retrieval_requests(spark, d), T.chunk_vectors(spark, d), method=method)


@query("retrieve_topk")
def retrieve_topk(spark: SparkSession, d: str) -> DataFrame:
    return _topk(spark, d, "auto")


@query("retrieve_topk_tiled")
def retrieve_topk_tiled(spark: SparkSession, d: str) -> DataFrame:
    return _topk(spark, d, "tiled")


@query("retrieve_topk_broadcast")
def retrieve_topk_broadcast(spark: SparkSession, d: str) -> DataFrame:
    return _topk(spark, d, "blocks")


def _ragged(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(requests, chunks) with string ids and vectors of two lengths, some null."""
    half = lambda v, n: F.when(F.col("i") % n == 0, F.slice(v, 1, 32)).otherwise(F.col(v))
    cv = T.chunk_vectors(spark, d).withColumn("i", F.col("chunk_id"))
    chunks = cv.select(F.concat(F.lit("c"), F.col("i").cast("string")).alias("chunk_id"),
                       F.concat(F.lit("m"), F.col("memory_id").cast("string")).alias("memory_id"), "space_id",
                       F.when(F.col("i") % 11 != 0, half("embedding", 3)).alias("embedding"))
    req = T.retrieval_requests(spark, d).withColumn("i", F.col("query_id"))
    req = req.select(F.concat(F.lit("q"), F.col("i").cast("string")).alias("query_id"),
                     F.when(F.col("i") % 13 != 0, half("query_vector", 4)).alias("query_vector"),
                     F.when(F.col("i") % 17 == 0, F.lit(" , ")).otherwise(F.col("space_ids")).alias("space_ids"),
                     F.when(F.col("i") % 19 == 0, F.lit("nope")).alias("reranker_id"), "max_results")
    return req, chunks


@query("retrieve_mixed")
def retrieve_mixed(spark: SparkSession, d: str) -> DataFrame:
    req, chunks = _ragged(spark, d)
    return R.retrieve_topk(req, chunks)


@query("retrieval_outcomes")
def retrieval_outcomes(spark: SparkSession, d: str) -> DataFrame:
    return P.retrieval_outcomes(_ragged(spark, d)[0])


def _mixed_requests(spark: SparkSession, d: str) -> DataFrame:
    """Retrieval requests plus chat-turn requests whose space lists are blank
    for system turns (error rows)."""
    req = T.retrieval_requests(spark, d).select("query_id", "space_ids")
    conv = T.conversations(spark, d).select(
        (F.col("conv_id") * 1000 + F.col("turn") + 1_000_000_000).alias("query_id"),
        F.when(F.col("role") == "user", F.concat(F.lit("conv-"), F.col("conv_id").cast("string")))
        .when(F.col("role") == "assistant",
              F.concat(F.lit(" conv-"), F.col("conv_id").cast("string"), F.lit(" ,,")))
        .otherwise(F.lit(" , ")).alias("space_ids"))
    return req.unionByName(conv)


@query("parse_space_keys")
def parse_space_keys(spark: SparkSession, d: str) -> DataFrame:
    p = R.parse_space_keys(_mixed_requests(spark, d))
    return p.select("query_id", F.size("space_keys").alias("n_keys"),
                    F.array_join("space_keys", "|").alias("space_keys"), "success", "error")


@query("restrict_to_spaces")
def restrict_to_spaces(spark: SparkSession, d: str) -> DataFrame:
    qs = R.restrict_to_spaces(T.retrieval_requests(spark, d))
    counts = (R.chunks_in_spaces(T.chunk_vectors(spark, d), qs)
              .groupBy("space_id").agg(F.count(F.lit(1)).alias("n_chunks")))
    return qs.join(counts, "space_id", "left").select(
        "query_id", "space_id", F.coalesce("n_chunks", F.lit(0)).alias("n_chunks"))


def _chain(spark: SparkSession, d: str, **opts) -> DataFrame:
    req = T.retrieval_requests(spark, d, **opts)
    return P.retrieve_postprocessed(req, T.chunk_vectors(spark, d), T.chunk_texts(spark, d),
                                    T.memories(spark, d))


_OUT = ["query_id", "rank", "chunk_id", "memory_id", "relevance_score", "memory_index",
        "total_results"]


@query("retrieve_postprocessed")
def retrieve_postprocessed(spark: SparkSession, d: str) -> DataFrame:
    return _chain(spark, d, reranker_id="jaccard", relevance_threshold=0.05,
                  chronological_resort=True, llm_id="extractive").select(*_OUT)


@query("rerank")
def rerank(spark: SparkSession, d: str) -> DataFrame:
    return _chain(spark, d, reranker_id="jaccard").select(*_OUT)


@query("relevance_threshold")
def relevance_threshold(spark: SparkSession, d: str) -> DataFrame:
    return _chain(spark, d, relevance_threshold=0.25).select(*_OUT)


@query("chronological_resort")
def chronological_resort(spark: SparkSession, d: str) -> DataFrame:
    return _chain(spark, d, chronological_resort=True).select(*_OUT)


@query("fetch_memory_definitions")
def fetch_memory_definitions(spark: SparkSession, d: str) -> DataFrame:
    res = _chain(spark, d)
    return R.fetch_memory_definitions(res, T.memories(spark, d)).select(
        "query_id", "memory_index", "memory_id", "memory_space_id", "processing_status", "created_at")


@query("result_totals")
def result_totals(spark: SparkSession, d: str) -> DataFrame:
    res = _chain(spark, d, relevance_threshold=0.25)
    return P.result_totals(res, T.retrieval_requests(spark, d))


@query("abstract_context")
def abstract_context(spark: SparkSession, d: str) -> DataFrame:
    res = _chain(spark, d, llm_id="extractive")
    return P.abstract_context(res, T.chunk_texts(spark, d))


@query("retrieve_text")
def retrieve_text(spark: SparkSession, d: str) -> DataFrame:
    """Natural-language retrieval end to end: every document chunked (fixed
    512/50) and embedded (hash-256); every benchmark item's text is a query,
    embedded the same way, searching all spaces; top 5 per query."""
    from memtables.operators import chunking as CH
    from memtables.operators.embedding import embed_chunks, embed_queries

    mem = T.memories(spark, d).select("memory_id", "space_id", "original_content")
    vectors = embed_chunks(CH.chunk_fixed(mem, 512, 50), "hash-256")
    req = T.read(spark, d, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query_text"),
        F.lit(5).alias("max_results"))
    return R.retrieve_topk(embed_queries(req), vectors, all_spaces=True)


@query("result_sets")
def result_sets(spark: SparkSession, d: str) -> DataFrame:
    """The result envelope per request (op 38 with memories and totals),
    reported as exact scalars: ids in rank / memory-index order."""
    req = (T.retrieval_requests(spark, d, relevance_threshold=0.25)
           .withColumn("llm_id", F.when(F.col("query_id") % 2 == 0, F.lit("extractive")))
           .withColumn("include_memory_definition", F.col("query_id") % 3 != 0))
    res = P.retrieve_postprocessed(req, T.chunk_vectors(spark, d), T.chunk_texts(spark, d),
                                   T.memories(spark, d))
    rs = P.result_sets(res, req, T.memories(spark, d))
    return rs.select(
        "query_id", "success", "error", "result_set_id", "total_results", "abstract_reply",
        F.size("memories").cast("long").alias("total_memories"),
        F.array_join(F.transform("results", lambda x: x["chunk_id"].cast("string")), ",").alias("chunk_ids"),
        F.array_join(F.transform("memories", lambda x: x["memory_id"].cast("string")), ",").alias("memory_ids"))
