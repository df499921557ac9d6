"""Entity and request tables built from the input tables.

The input tables (``documents``, ``events``, ``labels``, ``embeddings``,
``pages``, ``conversations``) are read with column pruning; every entity is a
plain DataFrame so Catalyst can push filters and prune columns down to the
Parquet scans. Nothing here collects to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from memtables import schema as S


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The input table as a lazy DataFrame, with its files as they are now."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# -- spaces / embedders ------------------------------------------------------

def space_labels() -> Column:
    return F.create_map(F.lit("kind"), F.lit("docs"))


def spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One space per document source; created at its earliest document event."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source")
    ev = read(spark, sf_dir, "events").select("event_id", "ts")
    first = (docs.join(ev, docs.doc_id == ev.event_id)
             .groupBy("source").agg(F.min("ts").alias("created_at")))
    return first.select(
        F.col("source").alias("space_id"),
        F.col("source").alias("name"),
        F.array(F.struct(F.lit("emb-64").alias("embedder_id"))).alias("space_embedders"),
        F.struct(F.lit(S.DEFAULT_CHUNKING_STRATEGY).alias("strategy"),
                 F.lit(S.DEFAULT_CHUNK_SIZE).alias("chunk_size"),
                 F.lit(S.DEFAULT_CHUNK_OVERLAP).alias("chunk_overlap")).alias("chunking"),
        F.lit(False).alias("public_read"),
        space_labels().alias("labels"),
        F.col("created_at"),
    )


# -- memories ----------------------------------------------------------------

def status_from_quality(q: Column) -> Column:
    return (F.when(q == 1, F.lit(S.STATUS_COMPLETED))
            .when(q == 0, F.lit(S.STATUS_FAILED)))


def memories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents x events (event_id = doc_id) with the label status.

    ``processing_status`` is null for unlabelled documents (read as PENDING)."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    ev = read(spark, sf_dir, "events").select("event_id", "ts", "props")
    lab = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("l_doc_id"), "quality")
    j = (docs.join(ev, docs.doc_id == ev.event_id)
         .join(lab, F.col("doc_id") == F.col("l_doc_id"), "left"))
    return j.select(
        F.col("doc_id").alias("memory_id"),
        F.col("source").alias("space_id"),
        F.lit(S.TEXT_CONTENT_TYPE).alias("content_type"),
        F.col("text").alias("original_content"),
        F.lit(None).cast("string").alias("original_content_b64"),
        F.try_parse_json("props").alias("metadata"),
        status_from_quality(F.col("quality")).alias("processing_status"),
        F.col("ts").alias("created_at"),
    )


# -- files -------------------------------------------------------------------

def page_suffix(page_id: Column) -> Column:
    r = F.pmod(page_id, F.lit(4))
    return (F.when(r == 0, ".pdf").when(r == 1, ".DOCX").when(r == 2, ".txt")
            .otherwise(""))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages as files: ``path``, ``content`` (UTF-8 bytes of the HTML), ``length``.
    Same columns as ``spark.read.format('binaryFile')`` minus the timestamp."""
    pages = read(spark, sf_dir, "pages").select("page_id", "html")
    content = F.encode("html", "UTF-8")
    return pages.select(
        "page_id",
        F.concat(F.lit("/p/"), F.col("page_id").cast("string"), page_suffix(F.col("page_id"))).alias("path"),
        content.alias("content"),
        F.octet_length(content).cast("long").alias("length"),
    )


# -- vectors / retrieval -----------------------------------------------------

def chunk_vectors(spark: SparkSession, sf_dir: str, with_text: bool = False) -> DataFrame:
    """embeddings as chunk vectors: chunk_id = vec_id, space ``label-<label>``,
    memory ``label*10 + vec_id % 7``. With ``with_text`` the chunk text is the
    document whose doc_id equals the chunk id (empty when there is none)."""
    emb = read(spark, sf_dir, "embeddings")
    cv = emb.select(
        F.col("vec_id").alias("chunk_id"),
        (F.col("label").cast("long") * 10 + F.pmod(F.col("vec_id"), F.lit(7))).alias("memory_id"),
        F.concat(F.lit("label-"), F.col("label").cast("string")).alias("space_id"),
        F.col("embedding"),
    )
    if with_text:
        cv = cv.join(chunk_texts(spark, sf_dir), "chunk_id", "left")
    return cv


def chunk_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("chunk_id"), F.coalesce("text", F.lit("")).alias("chunk_text"))
    return docs


def space_list_for_label(label: Column) -> Column:
    """The request's space list: its own label space, the next one, an empty
    entry and a repeat, e.g. ``label-3, label-4,,label-3``."""
    own = F.concat(F.lit("label-"), label.cast("string"))
    nxt = F.concat(F.lit("label-"), F.pmod(label + 1, F.lit(10)).cast("string"))
    return F.concat(own, F.lit(", "), nxt, F.lit(",,"), own)


def retrieval_requests(spark: SparkSession, sf_dir: str, *, max_results: int = S.DEFAULT_MAX_RESULTS,
                       reranker_id: str | None = None, relevance_threshold: float | None = None,
                       chronological_resort: bool | None = None, llm_id: str | None = None,
                       llm_temperature: float | None = None) -> DataFrame:
    """One retrieval request per embedding row: its vector is the query, its
    document text the query text."""
    emb = read(spark, sf_dir, "embeddings")
    qtext = read(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("query_id"), F.col("text").alias("query_text"))
    req = emb.select(
        F.col("vec_id").alias("query_id"),
        F.col("embedding").alias("query_vector"),
        space_list_for_label(F.col("label")).alias("space_ids"),
        F.lit(max_results).cast("int").alias("max_results"),
        F.lit(relevance_threshold).cast("double").alias("relevance_threshold"),
        F.lit(reranker_id).cast("string").alias("reranker_id"),
        F.lit(llm_id).cast("string").alias("llm_id"),
        F.lit(llm_temperature).cast("double").alias("llm_temperature"),
        F.lit(chronological_resort).cast("boolean").alias("chronological_resort"),
    )
    return req.join(qtext, "query_id", "left").select(*S.RETRIEVAL_REQUESTS.fieldNames())


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "conversations")
