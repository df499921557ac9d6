"""Ingest (ops 1-7, 47): a table of create-memory requests becomes memory rows
plus receipts; bad requests become error rows, never job failures.

Request columns (all but ``request_id`` and ``space_id`` optional):
``request_id, space_id, text, file_path, file_content (binary), metadata_json``.

Rules kept from the client:

* a non-empty file path wins over text; empty text counts as no text,
  whitespace-only text is accepted; neither -> error (3);
* content type from the lower-cased file name (4), text types are decoded as
  UTF-8 with U+FFFD for bad bytes, everything else is base64 without line
  breaks (5);
* metadata is a JSON object; empty / null / ``{}`` -> none; anything else is
  an error (6);
* the receipt carries the id, space, ``PENDING`` status and content type (7).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memtables import schema as S
from memtables.functions.json import strict_parse_json
from memtables.functions.text import base64_flat, java_trim, sha_id, valid_utf8
from memtables.operators.outcomes import first_error, with_outcome


def memory_id_of(space_id: Column, request_id: Column) -> Column:
    """Repeatable id: the SHA-256 of the natural key (space, request)."""
    return sha_id("memory", space_id, request_id)


def _non_empty(c: Column) -> Column:
    return c.isNotNull() & (c != "")


# -- 4 detect_content_type -----------------------------------------------------------

def detect_content_type(path: Column) -> Column:
    """Suffix table on the lower-cased file name; the fixed suffixes first, then
    our extra ones, else ``application/octet-stream``."""
    name = F.lower(F.regexp_extract(path, r"[^/\\]*$", 0))
    expr = F.lit(S.OCTET_STREAM)
    extra = F.create_map(*[F.lit(x) for kv in S.EXTRA_CONTENT_TYPES for x in kv])
    ext = F.regexp_extract(name, r"(\.[^.]*)$", 1)
    expr = F.coalesce(F.try_element_at(extra, ext), expr)
    for suffix, ctype in reversed(S.SUFFIX_CONTENT_TYPES):
        expr = F.when(name.endswith(suffix), F.lit(ctype)).otherwise(expr)
    return expr


# -- 5 encode_payload ----------------------------------------------------------------

def encode_payload(content_type: Column, content: Column) -> Column:
    """``struct<original_content, original_content_b64>``: text types decoded
    as UTF-8, other types base64-encoded."""
    is_text = content_type.startswith("text/")
    return F.struct(F.when(is_text, valid_utf8(content)).alias("original_content"),
                    F.when(~is_text, base64_flat(content)).alias("original_content_b64"))


# -- 6 attach_metadata ---------------------------------------------------------------

def metadata_of(metadata_json: Column) -> Column:
    """``struct<metadata variant, error string>``."""
    v = strict_parse_json(metadata_json)
    kind = F.schema_of_variant(v)
    given = _non_empty(metadata_json) & ~java_trim(metadata_json).isin("", "null")
    bad = given & (v.isNull() | ~kind.startswith("OBJECT"))
    empty = kind == "OBJECT<>"
    return F.struct(F.when(given & ~bad & ~empty, v).alias("metadata"),
                    F.when(bad, F.concat(F.lit(S.MSG_BAD_METADATA), metadata_json)).alias("error"))


# -- 1-3, 5-7 ingest -----------------------------------------------------------------

def ingest(requests: DataFrame) -> DataFrame:
    """Create-memory requests -> one row per request with the memory columns
    and the outcome (``success``, ``error``, ``message``)."""
    cols = set(requests.columns)
    text = F.col("text") if "text" in cols else F.lit(None).cast("string")
    path = F.col("file_path") if "file_path" in cols else F.lit(None).cast("string")
    content = F.col("file_content") if "file_content" in cols else F.lit(None).cast("binary")
    meta_json = F.col("metadata_json") if "metadata_json" in cols else F.lit(None).cast("string")

    use_file = _non_empty(path)
    use_text = ~use_file & _non_empty(text)
    ctype = F.when(use_file, detect_content_type(path)).when(use_text, F.lit(S.TEXT_CONTENT_TYPE))
    payload = encode_payload(ctype, content)
    meta = metadata_of(meta_json)
    # same order as the client: metadata is parsed before the content is looked at
    err = first_error(
        (meta["error"].isNotNull(), meta["error"]),
        (~use_file & ~use_text, S.MSG_NO_CONTENT),
        (use_file & content.isNull(), F.concat(F.lit(S.MSG_FILE_PREFIX), path)),
    )
    out = requests.select(
        "request_id", "space_id",
        F.when(use_file, F.lit("file")).when(use_text, F.lit("text")).alias("source_kind"),
        memory_id_of(F.col("space_id"), F.col("request_id")).alias("memory_id"),
        ctype.alias("content_type"),
        F.when(use_file, payload["original_content"]).when(use_text, text).alias("original_content"),
        F.when(use_file, payload["original_content_b64"]).alias("original_content_b64"),
        meta["metadata"].alias("metadata"),
        err.alias("_err"),
    )
    out = with_outcome(out, F.col("_err"), S.MSG_MEMORY_CREATED).drop("_err")
    return out.withColumn("memory_id", F.when(F.col("success"), F.col("memory_id")))


def to_memories(ingested: DataFrame, created_at: Column | None = None) -> DataFrame:
    """Good ingest rows as the ``memories`` table (status null = PENDING)."""
    ts = created_at if created_at is not None else F.localtimestamp()
    return ingested.where("success").select(
        "memory_id", "space_id", "content_type", "original_content", "original_content_b64",
        "metadata", F.lit(None).cast("string").alias("processing_status"),
        ts.cast("timestamp_ntz").alias("created_at"))


def ingest_ack(ingested: DataFrame) -> DataFrame:
    """One receipt per created memory."""
    return ingested.where("success").select(
        "request_id", "memory_id", "space_id",
        F.lit(S.STATUS_PENDING).alias("status"), "content_type", "message")


# -- 47 ingest_conversation -----------------------------------------------------------

def conversation_requests(conversations: DataFrame) -> DataFrame:
    """Chat turns as create-memory requests: one space per conversation, the
    role and turn as metadata (``conv_id, turn, role, text``)."""
    return conversations.select(
        F.col("turn").alias("request_id"),
        F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("space_id"),
        "conv_id", "turn", "role", "text",
        F.to_json(F.struct("role", "turn")).alias("metadata_json"))
