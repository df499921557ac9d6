"""Registered chunking and embedding queries (ops 39-43), over the whole
memory table with the default size 512 and overlap 50."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memtables.operators import chunking as CH
from memtables.operators.embedding import embed_by_space, embed_chunks, word_terms
from memtables.plans.registry import query
from memtables.sources import tables as T

_COLS = ["chunk_id", "memory_id", "space_id", "chunk_index", "chunk_text"]


def _mem(spark: SparkSession, d: str) -> DataFrame:
    return T.memories(spark, d).select("memory_id", "space_id", "original_content")


@query("chunk_none")
def chunk_none(spark: SparkSession, d: str) -> DataFrame:
    return CH.chunk_none(_mem(spark, d)).select(*_COLS)


@query("chunk_fixed")
def chunk_fixed(spark: SparkSession, d: str) -> DataFrame:
    return CH.chunk_fixed(_mem(spark, d), 512, 50).select(*_COLS)


@query("chunk_sentence")
def chunk_sentence(spark: SparkSession, d: str) -> DataFrame:
    return CH.chunk_sentence(_mem(spark, d), 512, 50).select(*_COLS)


@query("chunk_recursive")
def chunk_recursive(spark: SparkSession, d: str) -> DataFrame:
    return CH.chunk_recursive(_mem(spark, d), 512, 50).select(*_COLS)


@query("chunk_by_config")
def chunk_by_config(spark: SparkSession, d: str) -> DataFrame:
    """Documents in 60 spaces with 59 configs of all strategies; the last space is missing, so it takes the default."""
    mem = _mem(spark, d)
    n = F.regexp_extract("space_id", "[0-9]+$", 0).cast("int") * 3 + F.pmod("memory_id", F.lit(3)).cast("int")
    mem = mem.withColumn("n", n).withColumn("space_id", F.concat("space_id", F.lit("-"), F.pmod("memory_id", F.lit(3)).cast("string")))
    names = F.element_at(F.array(*map(F.lit, ("none", "fixed", "sentence", "recursive"))), F.col("n") % 4 + 1)
    sized = F.col("n") % 4 != 0
    spaces = mem.where("n < 59").select("space_id", "n").distinct().select("space_id", F.struct(
        names.alias("strategy"), F.when(sized, 300 + 8 * F.col("n")).alias("chunk_size"), F.when(sized, F.col("n") % 16).alias("chunk_overlap")).alias("chunking"))
    return CH.chunk_by_config(mem, spaces).select(*_COLS)


@query("embed_by_space")
def embed_by_space_q(spark: SparkSession, d: str) -> DataFrame:
    """Every memory as one chunk, embedded by its space's embedder: hash-256 for sources with
    an even last digit, emb-64 for odd ones, an unknown one where it is 9. Whole
    vectors, in millionths."""
    digit = F.substring("space_id", -1, 1)
    name = F.when(digit == "9", "nope").when(digit.isin("0", "2", "4", "6", "8"), "hash-256").otherwise("emb-64")
    spaces = T.spaces(spark, d).withColumn("space_embedders", F.array(F.struct(name.alias("embedder_id"))))
    out = embed_by_space(CH.chunk_none(_mem(spark, d)), spaces)
    return out.select("chunk_id", "embedder_id", "success", "error", F.array_join(F.transform(
        "embedding", lambda x: F.round(x.cast("double") * 1_000_000).cast("long").cast("string")), ",").alias("vector"))


@query("embed_chunks")
def embed_chunks_q(spark: SparkSession, d: str) -> DataFrame:
    """Every fixed chunk embedded with hash-256; reported as exact summaries
    of each vector (dimension, words, non-zero buckets, largest bucket and
    its value)."""
    chunks = CH.chunk_fixed(_mem(spark, d), 512, 50)
    e = F.col("embedding")
    top = F.array_max(e)
    return embed_chunks(chunks, "hash-256").select(
        "chunk_id", "memory_id", "space_id",
        F.size(e).alias("dim"),
        F.size(word_terms("chunk_text")).alias("n_terms"),
        F.size(F.filter(e, lambda x: x > 0)).alias("nnz"),
        (F.array_position(e, top) - 1).cast("int").alias("top_bucket"),
        F.round(top.cast("double"), 6).alias("top_value"))
