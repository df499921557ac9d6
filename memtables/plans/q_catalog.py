"""Registered catalogue and memory queries (ops 11, 13-20, 23-29, 34).

Request tables are derived from the input tables, so each query's work grows
with them: one request per source or language, per labelled document, and so
on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memtables.functions.json import labels_text, val, val_of
from memtables.operators import catalog as C
from memtables.operators import memories as M
from memtables.operators.embedding import embedder_registry
from memtables.plans.registry import query
from memtables.sources import files as FS
from memtables.sources import tables as T


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return T.read(spark, d, "documents").select("doc_id", "source", "lang")


# -- spaces ----------------------------------------------------------------------------

@query("list_spaces")
def list_spaces(spark: SparkSession, d: str) -> DataFrame:
    sp = C.list_spaces(T.spaces(spark, d), ordered=False)
    return sp.select("space_id", "name", C.first_embedder(F.col("space_embedders")).alias("embedder_id"),
                     "chunking.strategy", "chunking.chunk_size", "chunking.chunk_overlap",
                     "public_read", labels_text(F.col("labels")).alias("labels"), "created_at",
                     "total_spaces")


def _get_requests(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d)
    return (docs.select(F.col("source").alias("space_id"))
            .union(docs.select(F.col("lang").alias("space_id"))).distinct())


@query("get_space")
def get_space(spark: SparkSession, d: str) -> DataFrame:
    g = C.get_spaces(_get_requests(spark, d), T.spaces(spark, d))
    return g.select("space_id", "success", "error", "name",
                    C.first_embedder(F.col("space_embedders")).alias("embedder_id"))


@query("list_embedders")
def list_embedders(spark: SparkSession, d: str) -> DataFrame:
    return C.list_embedders(embedder_registry(spark), T.spaces(spark, d))


def create_requests(spark: SparkSession, d: str) -> DataFrame:
    """Per source: reuse. Per language: create then reuse, an unknown strategy,
    an invalid overlap followed by a valid create and a reuse."""
    docs = _docs(spark, d)
    src = docs.groupBy("source").agg(F.min("doc_id").alias("m")).select(
        F.col("m").alias("seq"), F.col("source").alias("name"), F.lit("hash-256").alias("embedder_id"),
        F.lit(None).cast("string").alias("strategy"), F.lit(None).cast("int").alias("chunk_size"),
        F.lit(None).cast("int").alias("chunk_overlap"))
    lg = docs.groupBy("lang").agg(F.min("doc_id").alias("m"))
    rows = [  # (offset, name prefix, embedder, strategy, size, overlap)
        (0, "lang-", "hash-256", "sentence", 256, 32),
        (1, "lang-", "hash-256", "none", None, None),
        (2, "bad-", "emb-64", "semantic", 256, 32),
        (3, "tight-", "emb-64", "fixed", 64, 64),
        (4, "tight-", "emb-64", "fixed", 64, 16),
        (5, "tight-", "hash-256", "fixed", 64, 80),
    ]
    each = F.array(*(F.struct(
        (F.lit(1_000_000) + F.col("m") * 10 + off).alias("seq"),
        F.concat(F.lit(prefix), F.col("lang")).alias("name"),
        F.lit(emb).alias("embedder_id"), F.lit(st).cast("string").alias("strategy"),
        F.lit(size).cast("int").alias("chunk_size"), F.lit(ov).cast("int").alias("chunk_overlap"))
        for off, prefix, emb, st, size, ov in rows))
    return src.unionByName(lg.select(F.explode(each).alias("r")).select("r.*"))


@query("create_or_reuse_spaces")
def create_or_reuse_spaces(spark: SparkSession, d: str) -> DataFrame:
    rec, _ = C.create_or_reuse_spaces(T.spaces(spark, d), create_requests(spark, d))
    return rec.select("seq", "name", "space_id", "embedder_id", "strategy", "chunk_size",
                      "chunk_overlap", "reused", "success", "error", "message")


@query("create_or_reuse_catalog")
def create_or_reuse_catalog(spark: SparkSession, d: str) -> DataFrame:
    """The catalogue after the requests, each sent ``seq`` seconds into 2024."""
    at = F.timestamp_add("SECOND", F.col("seq"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    _, snap = C.create_or_reuse_spaces(T.spaces(spark, d), create_requests(spark, d).withColumn("created_at", at))
    return snap.select("space_id", "name", C.first_embedder(F.col("space_embedders")).alias("embedder_id"),
                       "chunking.strategy", "chunking.chunk_size", "chunking.chunk_overlap", "public_read",
                       labels_text(F.col("labels")).alias("labels"), "created_at")


@query("chunking_config")
def chunking_config(spark: SparkSession, d: str) -> DataFrame:
    r = create_requests(spark, d)
    cfg = C.chunking_config(F.col("strategy"), F.col("chunk_size"), F.col("chunk_overlap"))
    return r.select("seq", cfg.alias("c")).select("seq", "c.strategy", "c.chunk_size",
                                                  "c.chunk_overlap", "c.error")


def update_requests(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d)
    n = F.pmod(F.col("m"), F.lit(5))
    src = docs.groupBy("source").agg(F.min("doc_id").alias("m")).select(
        F.col("source").alias("space_id"),
        F.when(n == 0, F.concat(F.lit("renamed-"), F.col("source"))).alias("name"),
        F.when(n == 1, F.lit(True)).alias("public_read"),
        F.when(n == 2, F.lit('{"team":"nlp"}')).when(n == 4, F.lit('{"team":"nlp"}'))
        .alias("replace_labels_json"),
        F.when(n == 1, F.lit('{"level": 3, "flag": true, "drop": null}'))
        .when(n == 3, F.lit('{"team":"nlp","kind":"merged"}'))
        .when(n == 4, F.lit('{"a": "b"}')).alias("merge_labels_json"))
    unknown = docs.select("lang").distinct().select(
        F.col("lang").alias("space_id"), F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("boolean").alias("public_read"),
        F.concat(F.lit('{"lang":"'), F.col("lang"), F.lit('"}')).alias("replace_labels_json"),
        F.lit(None).cast("string").alias("merge_labels_json"))
    return src.unionByName(unknown)


@query("update_spaces")
def update_spaces(spark: SparkSession, d: str) -> DataFrame:
    rec, _ = C.update_spaces(T.spaces(spark, d), update_requests(spark, d))
    return rec.select("space_id", "success", "error", "name", "public_read",
                      labels_text(F.col("labels")).alias("labels"), "message")


@query("merge_labels")
def merge_labels(spark: SparkSession, d: str) -> DataFrame:
    """The updated catalogue after the patches: labels merged / replaced."""
    _, snap = C.update_spaces(T.spaces(spark, d), update_requests(spark, d))
    return snap.select("space_id", "name", "public_read", labels_text(F.col("labels")).alias("labels"))


def patch_sequence(spark: SparkSession, d: str) -> DataFrame:
    """Four patches per source: merge, rename and publish, a patch in error, replace or merge."""
    src = _docs(spark, d).groupBy("source").agg(F.min("doc_id").alias("m"))
    text = lambda c: F.lit(c).cast("string") if c is None or isinstance(c, str) else c
    row = lambda n, name, public, replace, merge: F.struct(
        F.lit(n).alias("seq"), text(name).alias("name"), F.lit(public).cast("boolean").alias("public_read"),
        text(replace).alias("replace_labels_json"), text(merge).alias("merge_labels_json"))
    odd = F.pmod(F.col("m"), F.lit(2)) == 1
    rows = F.array(row(1, None, None, None, '{"a":"1","kind":"x"}'), row(2, F.concat(F.lit("new-"), F.col("source")), True, None, None),
                   row(3, "lost", None, '{"b":[1]}', None),
                   row(4, None, None, F.when(odd, F.lit('{"c":"3"}')), F.when(~odd, F.lit('{"a":"4"}'))))
    return src.select(F.col("source").alias("space_id"), F.explode(rows).alias("r")).select("space_id", "r.*")


@query("update_spaces_sequence")
def update_spaces_sequence(spark: SparkSession, d: str) -> DataFrame:
    """Receipts of several patches per space, and (``seq`` null) the catalogue after them."""
    rec, snap = C.update_spaces(T.spaces(spark, d), patch_sequence(spark, d))
    snap = snap.withColumn("seq", F.lit(None).cast("long")).withColumn("success", F.lit(None).cast("boolean")) \
        .withColumn("error", F.lit(None).cast("string"))
    cols = ["space_id", "seq", "success", "error", "name", "public_read", labels_text(F.col("labels")).alias("labels")]
    return rec.select(*cols).unionByName(snap.select(*cols))


@query("parse_labels")
def parse_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels as they are, with null, typed, nested and blank values, with text behind and not an object."""
    i = F.col("event_id")
    text = i.cast("string")
    cases = [F.col("props"), F.concat(F.lit('{"n":null,"i":'), text, F.lit(',"b":true,"s":"x'), text, F.lit('"}')),
             F.concat(F.lit('{"a":{"n":'), text, F.lit("}}")), F.concat(F.lit('{"a":"b"} '), text), F.concat(F.lit("["), text, F.lit("]"))]
    raw = F.lit(" ")
    for n, case in enumerate(cases):
        raw = F.when(i % 6 == n, case).otherwise(raw)
    p = C.parse_labels(T.read(spark, d, "events").select("event_id", raw.alias("raw")), "raw")
    return p.select("event_id", labels_text(F.col("labels")).alias("labels"), "success", "error")


def _toxic(spark: SparkSession, d: str) -> DataFrame:
    return T.read(spark, d, "labels").where(F.col("toxic") == 1).select("doc_id")


@query("delete_spaces")
def delete_spaces(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d)
    hit = docs.join(_toxic(spark, d), "doc_id", "left_semi").select(F.col("source").alias("space_id"))
    gone = docs.select(F.concat(F.lit("gone-"), F.col("lang")).alias("space_id"))
    req = hit.union(gone).distinct()
    rec, *_ = C.delete_spaces(req, T.spaces(spark, d), T.memories(spark, d))
    return rec.select("space_id", "success", "error", "deleted_memories", "message")


def _tables(**tables: tuple[DataFrame, str]) -> DataFrame:
    """All rows of some tables (with their id columns) by name, id and space."""
    parts = [df.select(F.lit(name).alias("tbl"), F.col(key).cast("string").alias("id"), "space_id") for name, (df, key) in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("delete_spaces_tables")
def delete_spaces_tables(spark: SparkSession, d: str) -> DataFrame:
    """What is left in every table after every other source's space is deleted."""
    req = (_docs(spark, d).groupBy(F.col("source").alias("space_id")).agg(F.min("doc_id").alias("m"))
           .where(F.pmod(F.col("m"), F.lit(2)) == 0).select("space_id"))
    mem = T.memories(spark, d).select("memory_id", "space_id")
    chunks = mem.select(F.concat(F.col("memory_id").cast("string"), F.lit("-0")).alias("chunk_id"), "memory_id", "space_id")
    _, sp, m, c, v = C.delete_spaces(req, T.spaces(spark, d), mem, chunks, T.chunk_vectors(spark, d).drop("embedding"))
    return _tables(spaces=(sp, "space_id"), memories=(m, "memory_id"), chunks=(c, "chunk_id"), vectors=(v, "chunk_id"))


@query("delete_memories_tables")
def delete_memories_tables(spark: SparkSession, d: str) -> DataFrame:
    """What is left in every table after the toxic documents' memories are deleted."""
    mem = T.memories(spark, d).select("memory_id", "space_id")
    chunks = mem.select(F.concat(F.col("memory_id").cast("string"), F.lit("-0")).alias("chunk_id"), "memory_id", "space_id")
    _, m, c, v = C.delete_memories(_toxic(spark, d).select(F.col("doc_id").alias("memory_id")), mem, chunks,
                                   T.chunk_vectors(spark, d).drop("embedding"))
    return _tables(memories=(m, "memory_id"), chunks=(c, "chunk_id"), vectors=(v, "chunk_id"))


@query("delete_memories")
def delete_memories(spark: SparkSession, d: str) -> DataFrame:
    tox = _toxic(spark, d)
    req = tox.select(F.col("doc_id").alias("memory_id")).union(
        tox.select((-F.col("doc_id") - 1).alias("memory_id")))
    rec, *_ = C.delete_memories(req, T.memories(spark, d), vectors=T.chunk_vectors(spark, d))
    return rec.select("memory_id", "success", "error", "deleted_vectors", "message")


# -- memories --------------------------------------------------------------------------

def _list_requests(spark: SparkSession, d: str, status: str | None) -> DataFrame:
    return (_docs(spark, d).select(F.col("source").alias("space_id")).distinct()
            .select(F.col("space_id").alias("request_id"), "space_id",
                    F.lit(10).alias("page_size"), F.lit(None).cast("string").alias("next_token"),
                    F.lit(status).cast("string").alias("status")))


@query("list_memories")
def list_memories(spark: SparkSession, d: str) -> DataFrame:
    page = M.list_memories(T.memories(spark, d), _list_requests(spark, d, "COMPLETED"),
                           where=val("$.k", "int") < 50)
    return page.select("request_id", "memory_id", "processing_status", "created_at",
                       val("$.k", "int").alias("k"), "position", "total_memories", "next_token")


@query("list_memories_by_token")
def list_memories_by_token(spark: SparkSession, d: str) -> DataFrame:
    """Each source's second page, asked by the first one's token, and a request with a
    malformed token for each source."""
    mem = T.memories(spark, d)
    first = M.list_memories(mem, _list_requests(spark, d, None)).where("next_token is not null and position = 1")
    after = first.select("request_id", "space_id", F.lit(10).alias("page_size"), "next_token", F.lit(None).cast("string").alias("status"))
    bad = _list_requests(spark, d, None).withColumn("request_id", F.concat(F.lit("bad-"), F.col("request_id"))).withColumn("next_token", F.lit("a"))
    return M.list_memories(mem, after.unionByName(bad)).select(
        "request_id", "space_id", "memory_id", "position", "total_memories", "next_token", "success", "error")


@query("project_content")
def project_content(spark: SparkSession, d: str) -> DataFrame:
    page = M.list_memories(T.memories(spark, d), _list_requests(spark, d, None), include_content=True)
    return page.select("request_id", "memory_id", "content_type", "original_content", "position")


@query("filter_by_status")
def filter_by_status(spark: SparkSession, d: str) -> DataFrame:
    m = M.filter_by_status(T.memories(spark, d), "PENDING")
    return m.select("memory_id", "space_id", M.status_of().alias("processing_status"))


@query("filter_by_metadata")
def filter_by_metadata(spark: SparkSession, d: str) -> DataFrame:
    m = M.filter_by_metadata(T.memories(spark, d), val("$.k", "int") < 50)
    return m.select("memory_id", "space_id", val("$.k", "int").alias("k"))


@query("filter_by_path_columns")
def filter_by_path_columns(spark: SparkSession, d: str) -> DataFrame:
    """The same filter over stored memories whose path ``$.k`` has a typed column."""
    paths = FS.write_memory_tables({"memories": T.memories(spark, d)}, spark=spark, paths={"meta_k": ("$.k", "int")})
    stored = FS.read_memory_table(spark, paths["memories"])
    m = M.filter_by_metadata(stored, lambda val: val("$.k", "int") < 50)
    return m.select("memory_id", "space_id", val_of(m)("$.k", "int").alias("k"))


def _get_requests_mem(spark: SparkSession, d: str) -> DataFrame:
    lab = T.read(spark, d, "labels")
    return lab.select(F.col("doc_id").alias("memory_id")).union(
        lab.where(F.col("toxic") == 1).select((-F.col("doc_id") - 1).alias("memory_id")))


@query("get_memory")
def get_memory(spark: SparkSession, d: str) -> DataFrame:
    g = M.get_memories(_get_requests_mem(spark, d), T.memories(spark, d))
    return g.select("memory_id", "success", "error", "space_id",
                    F.when(F.col("success"), M.status_of()).alias("processing_status"),
                    "content_kind", "content", "content_error")


@query("negotiate_content")
def negotiate_content(spark: SparkSession, d: str) -> DataFrame:
    """Stored contents: documents as text/plain, event props as JSON (the
    'error' events hold a broken JSON body)."""
    docs = T.read(spark, d, "documents").select(
        (F.col("doc_id") * 2).alias("memory_id"), F.lit("text/plain").alias("content_type"),
        F.col("text").alias("stored"))
    ev = T.read(spark, d, "events").select(
        (F.col("event_id") * 2 + 1).alias("memory_id"),
        F.lit("application/json; charset=utf-8").alias("content_type"),
        F.when(F.col("event_type") == "error", F.substring("props", F.lit(2), F.length("props")))
        .otherwise(F.col("props")).alias("stored"))
    both = docs.unionByName(ev)
    neg = M.negotiate_content(F.col("content_type"), F.col("stored"))
    return both.select("memory_id", neg.alias("n")).select("memory_id", "n.*")


@query("page_memories")
def page_memories(spark: SparkSession, d: str) -> DataFrame:
    return M.page_all(T.memories(spark, d), page_size=100).select(
        "space_id", "memory_id", "page_no", "position", "next_token")
