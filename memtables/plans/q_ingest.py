"""Registered ingest queries (ops 1-7, 12, 45, 47)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memtables.operators.outcomes import outcome_json, split_outcomes
from memtables.plans.registry import query
from memtables.session import materialized, shared_dir
from memtables.sources import files as FS
from memtables.sources import ingest as I
from memtables.sources import tables as T


def _text_requests(spark: SparkSession, d: str) -> DataFrame:
    return T.read(spark, d, "documents").select(
        F.col("doc_id").alias("request_id"), F.col("source").alias("space_id"), "text")


def _file_requests(spark: SparkSession, d: str) -> DataFrame:
    return FS.file_requests(T.files(spark, d), "pages")


@query("ingest_text")
def ingest_text(spark: SparkSession, d: str) -> DataFrame:
    return I.ingest(_text_requests(spark, d)).select(
        "request_id", "space_id", "memory_id", "content_type", "original_content", "success", "error")


@query("ingest_files")
def ingest_files(spark: SparkSession, d: str) -> DataFrame:
    return I.ingest(_file_requests(spark, d)).select(
        "request_id", "memory_id", "content_type", "original_content", "original_content_b64",
        "success", "error")


@query("ingest_files_from_disk")
def ingest_files_from_disk(spark: SparkSession, d: str) -> DataFrame:
    """Twenty pages to a text file, written to disk and read back as files."""
    path = shared_dir(spark, "files")
    FS.write_page_files(T.read(spark, d, "pages"), path, F.floor(F.col("page_id") / 20))
    files = FS.read_files(spark, path)
    number = F.regexp_extract("request_id", "file=([0-9]+)/", 1).cast("long")
    out = I.ingest(FS.file_requests(files, "pages")).join(files.select(F.col("path").alias("request_id"), "length"), "request_id")
    return out.select(number.alias("file"), "content_type", "original_content", "length", "success")


@query("resolve_content")
def resolve_content(spark: SparkSession, d: str) -> DataFrame:
    """Documents with a page of the same id carry both a file and text: the file wins."""
    f = T.files(spark, d).select(F.col("page_id").alias("request_id"), F.col("path").alias("file_path"),
                                 F.col("content").alias("file_content"))
    req = _text_requests(spark, d).join(f, "request_id", "left")
    return I.ingest(req).select("request_id", "source_kind", "content_type", "success", "error")


@query("detect_content_type")
def detect_content_type(spark: SparkSession, d: str) -> DataFrame:
    return T.files(spark, d).select("path", I.detect_content_type(F.col("path")).alias("content_type"))


@query("encode_payload")
def encode_payload(spark: SparkSession, d: str) -> DataFrame:
    f = T.files(spark, d).withColumn("content_type", I.detect_content_type(F.col("path")))
    p = I.encode_payload(F.col("content_type"), F.col("content"))
    return f.select("path", "content_type", p["original_content"].alias("original_content"),
                    p["original_content_b64"].alias("original_content_b64"))


def _metadata_requests(spark: SparkSession, d: str) -> DataFrame:
    """Event rows as text memories with their props as metadata; 'error'
    events carry a broken JSON text, 'signup' events an empty object."""
    ev = T.read(spark, d, "events")
    meta = (F.when(F.col("event_type") == "error", F.substring("props", F.lit(2), F.length("props")))
            .when(F.col("event_type") == "signup", F.lit("{}")).otherwise(F.col("props")))
    return ev.select(F.col("event_id").alias("request_id"), F.lit("events").alias("space_id"),
                     F.col("event_type").alias("text"), meta.alias("metadata_json"))


@query("attach_metadata")
def attach_metadata(spark: SparkSession, d: str) -> DataFrame:
    out = I.ingest(_metadata_requests(spark, d))
    return out.select("request_id", F.to_json("metadata").alias("metadata"), "success", "error")


@query("ingest_ack")
def ingest_ack(spark: SparkSession, d: str) -> DataFrame:
    return I.ingest_ack(I.ingest(_text_requests(spark, d)))


@query("outcomes")
def outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Outcome rows of a metadata ingest: good rows and the quarantine, each
    with its JSON form (null members left out)."""
    out = I.ingest(_metadata_requests(spark, d))
    good, bad = split_outcomes(out)
    cols = ["request_id", "success", "error"]
    return (good.select(*cols, outcome_json(good, "memory_id", "message").alias("outcome"))
            .unionByName(bad.select(*cols, outcome_json(bad, "memory_id", "message").alias("outcome"))))


@query("write_memory_tables")
def write_memory_tables(spark: SparkSession, d: str) -> DataFrame:
    paths = FS.write_memory_tables({"memories": T.memories(spark, d)}, spark=spark)
    back = FS.read_memory_table(spark, paths["memories"])
    return back.select("memory_id", "space_id", "content_type", "processing_status", "created_at",
                       F.to_json("metadata").alias("metadata"))


@query("write_tables_of_number_ids")
def write_tables_of_number_ids(spark: SparkSession, d: str) -> DataFrame:
    """Spaces, memories and vectors written and read back with space ids that look like
    numbers (``007``); the rows of every table by space."""
    ids = lambda df: df.withColumn("space_id", F.concat(F.lit("00"), F.regexp_extract("space_id", "[0-9]+$", 0)))
    paths = FS.write_memory_tables({"spaces": ids(T.spaces(spark, d)), "memories": ids(T.memories(spark, d)),
                                    "vectors": ids(T.chunk_vectors(spark, d))}, spark=spark)
    out = None
    for name, path in paths.items():
        part = FS.read_memory_table(spark, path).groupBy("space_id").agg(F.count("*").alias("n")).select(F.lit(name).alias("tbl"), "space_id", "n")
        out = part if out is None else out.unionByName(part)
    return out


@query("ingest_conversation")
def ingest_conversation(spark: SparkSession, d: str) -> DataFrame:
    req = I.conversation_requests(T.conversations(spark, d))
    out = I.ingest(req)
    return out.select("space_id", F.col("request_id").alias("turn"), "memory_id", "content_type",
                      "original_content", F.to_json("metadata").alias("metadata"), "success")


@query("conversation_search")
def conversation_search(spark: SparkSession, d: str) -> DataFrame:
    """The chat scenario end to end: turns ingested as memories of one space
    per conversation (1, 6), one chunk per turn embedded with the hashed
    embedder (39, 43), every user turn searching its own conversation (35)
    with results resorted by turn order (37)."""
    from memtables.operators import chunking as CH
    from memtables.operators import postprocess as P
    from memtables.operators.embedding import embed_chunks

    conv = T.conversations(spark, d)
    ing = I.ingest(I.conversation_requests(conv)).where("success")
    turn_time = F.timestamp_add("SECOND", F.col("request_id"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    # both are read several times: as requests, as the searched table and as memories
    memories = materialized(ing.select("memory_id", "space_id", "original_content", turn_time.alias("created_at"),
                                       F.try_variant_get("metadata", "$.role", "string").alias("role")))
    chunks = CH.chunk_none(memories)
    vectors = materialized(embed_chunks(chunks, "hash-256"))
    users = memories.where("role = 'user'").join(vectors.select("memory_id", "embedding"), "memory_id")
    requests = users.select(
        F.col("memory_id").alias("query_id"), F.col("embedding").alias("query_vector"),
        F.col("original_content").alias("query_text"), F.col("space_id").alias("space_ids"),
        F.lit(5).alias("max_results"), F.lit(None).cast("double").alias("relevance_threshold"),
        F.lit(None).cast("string").alias("reranker_id"), F.lit(None).cast("string").alias("llm_id"),
        F.lit(None).cast("double").alias("llm_temperature"), F.lit(True).alias("chronological_resort"))
    res = P.retrieve_postprocessed(requests, vectors, vectors, memories)
    return res.select("query_id", "rank", "chunk_id", "memory_id", "relevance_score", "memory_index",
                      "total_results", "created_at")
