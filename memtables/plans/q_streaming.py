"""Registered streaming queries (ops 44, 46)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memtables.plans.registry import query
from memtables.session import shared_dir
from memtables.sources import files as FS
from memtables.sources import ingest as I
from memtables.sources import tables as T
from memtables.streaming import indexing as IX


@query("stream_index_memories")
def stream_index_memories(spark: SparkSession, d: str) -> DataFrame:
    """All documents indexed by the stream (fixed 512/50 chunks, hash-256
    vectors); the status table read back after the stream has drained."""
    child, out = IX.run_to_completion(spark, lambda s: IX.documents_stream(s, d), chunker=IX.fixed_chunker)
    return IX.latest_status(child, out).select("memory_id", "processing_status", "n_chunks")


@query("stream_index_resumed")
def stream_index_resumed(spark: SparkSession, d: str) -> DataFrame:
    """Three arrivals, each indexed by a run that resumes from the same checkpoint and state store: all
    memories but every seventh, every third without its text; every second of them again, as
    they were; the late sevenths, and the thirds with their text. Status, attempts and vectors of each."""
    memories = T.memories(spark, d).select("memory_id", "space_id", "original_content", "created_at")
    i, text = F.col("memory_id"), F.col("original_content")
    first = memories.where(i % 7 != 0).withColumn("original_content", F.when(i % 3 != 0, text))
    arrivals = [first, first.where(i % 2 == 0), memories.where((i % 3 == 0) | (i % 7 == 0))]
    root = shared_dir(spark, "indexing")
    child = spark.newSession()
    child.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    for n, rows in enumerate(arrivals):
        rows.write.parquet(f"{root}/in/arrival={n}")
        arriving = child.readStream.schema(memories.schema).parquet(f"{root}/in/arrival=*")
        IX.drain(IX.stream_index_memories(arriving, f"{root}/out", f"{root}/checkpoint", chunker=IX.fixed_chunker))
    vectors = IX.indexed_vectors(child, f"{root}/out")
    e = F.col("embedding")
    per = vectors.groupBy("memory_id").agg(
        F.count(F.lit(1)).alias("n_vectors"), F.sum(F.size(F.filter(e, lambda x: x > 0))).cast("long").alias("nnz"),
        F.sum(F.round(F.array_max(e).cast("double") * 1_000_000).cast("long")).alias("top_millionths"))
    status = IX.latest_status(child, f"{root}/out").select("memory_id", "processing_status", "n_chunks", "error", "attempt")
    return status.join(per, "memory_id", "left")


@query("stream_ingest_files")
def stream_ingest_files(spark: SparkSession, d: str) -> DataFrame:
    """Files indexed as they arrive: half of the page files, then the others and some of the first again,
    each time by a run that resumes from the checkpoint."""
    pages, n = T.read(spark, d, "pages"), F.floor(F.col("page_id") / 20)
    root = shared_dir(spark, "arriving")
    child = spark.newSession()
    child.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    for arrival, some in enumerate((n % 2 == 0, (n % 2 == 1) | (n % 4 == 0))):
        FS.write_page_files(pages.where(some), f"{root}/in/arrival={arrival}", n)
        files = FS.stream_files(child, f"{root}/in")
        name = F.concat(F.lit("file-"), F.regexp_extract("path", "file=([0-9]+)/", 1))
        requests = FS.file_requests(files, "pages").withColumn("request_id", F.col("file_path"))
        memories = I.ingest(requests).where("success").select(
            F.col("request_id").alias("path"), "space_id", "original_content", F.current_timestamp().alias("created_at")).withColumn("memory_id", name)
        IX.drain(IX.stream_index_memories(memories, f"{root}/out", f"{root}/checkpoint", chunker=IX.fixed_chunker))
    return IX.latest_status(child, f"{root}/out").select("memory_id", "processing_status", "n_chunks", "attempt")


@query("indexing_freshness")
def indexing_freshness(spark: SparkSession, d: str) -> DataFrame:
    return IX.indexing_freshness(T.memories(spark, d))


@query("wait_for_indexing")
def wait_for_indexing(spark: SparkSession, d: str) -> DataFrame:
    """Retrieval over spaces that may still be indexing: each chat turn asks
    its own conversation space (which holds no vectors yet) and a vector
    space; queries with no results over unfinished spaces get the message."""
    from memtables.operators import postprocess as P
    from memtables.operators import retrieval as R
    req = T.retrieval_requests(spark, d)
    # search the label spaces and the source space of the query's document
    src = T.read(spark, d, "documents").select(F.col("doc_id").alias("query_id"),
                                               F.col("source").alias("_src"))
    req = (req.join(src, "query_id", "left")
           .withColumn("space_ids", F.when(F.pmod(F.col("query_id"), F.lit(2)) == 0, F.col("_src"))
                       .otherwise(F.col("space_ids")))
           .drop("_src"))
    res = R.retrieve_topk(req, T.chunk_vectors(spark, d))
    totals = P.result_totals(res, req)
    return IX.wait_messages(totals, req, IX.indexing_freshness(T.memories(spark, d))).select(
        "query_id", "total_results", "message")
