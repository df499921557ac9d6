"""Memory listings (16) with status (17) and metadata (18) filters, content
projection (19), get by id (20) with content negotiation (11), keyset paging
(34).

Listing many spaces at once is a per-request top-(n+1) (``row_number`` with a
limit, planned as a partial ``WindowGroupLimit`` before the shuffle, so a hot
space sends at most n+1 rows per task). Paging a whole table uses range
partitioning and per-partition offsets, never a window over one whole space.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from memtables import schema as S
from memtables.functions.json import strict_parse_json, val, val_of  # noqa: F401  (val re-exported)
from memtables.operators.outcomes import first_error, with_outcome
from memtables.operators.sizing import MAX_BROADCAST_ROWS, reduce_to_keys
from memtables.session import materialized

#: group limits below this are planned before the shuffle; a whole page and one row more must fit
GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"

CONTENT_COLS = ("original_content", "original_content_b64")


Predicate = Column | Callable[[Callable[..., Column]], Column]


def status_of(col: str = "processing_status") -> Column:
    return F.coalesce(F.col(col), F.lit(S.STATUS_PENDING))


# -- 17 / 18 / 19 ---------------------------------------------------------------------

def filter_by_status(memories: DataFrame, status: str | Column | None) -> DataFrame:
    """Equality on processing status (null means PENDING); null or empty = all."""
    if status is None or (isinstance(status, str) and status == ""):
        return memories
    if isinstance(status, str):
        # plain comparisons on the column, so the Parquet scan can take them
        col = F.col("processing_status")
        if status == S.STATUS_PENDING:
            return memories.where(col.isNull() | (col == status))
        return memories.where(col == status)
    return memories.where((status == "") | status.isNull() | (status_of() == status))


def filter_by_metadata(memories: DataFrame, predicate: Predicate | None) -> DataFrame:
    """Any Column predicate, typically over ``val('$.path', type)``; or a function of ``val``, which reads the
    table's typed path columns where it has them: ``lambda val: val('$.k', 'int') < 50``."""
    if predicate is None:
        return memories
    return memories.where(predicate if isinstance(predicate, Column) else predicate(val_of(memories)))


def project_content(memories: DataFrame, include_content: bool) -> DataFrame:
    """Content columns only when asked (column pruning reaches the scan)."""
    return memories if include_content else memories.drop(*CONTENT_COLS)


# -- 34 keyset tokens ------------------------------------------------------------------
# Rows stand in order of creation time (nulls first), then id.

def page_token(created_at: Column, memory_id: Column) -> Column:
    """Opaque token: base64 of ``<created_at>|<memory_id>`` of the last row (a null
    creation time is empty)."""
    at = F.coalesce(created_at.cast("string"), F.lit(""))
    return F.base64(F.encode(F.concat(at, F.lit("|"), memory_id.cast("string")), "UTF-8"))


def read_token(token: Column, memories: DataFrame) -> Column:
    """``struct<ok, at, id>``: the key in ``token``, in the types of ``memories``' columns.
    Null and empty tokens are ok and have a null ``id``; ``ok`` is false for
    anything that :func:`page_token` can't have made."""
    text = F.try_validate_utf8(F.try_to_binary(token, F.lit("base64")).cast("string"))
    parts = F.split(text, r"\|", 2)
    at_text, id_text = F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(2))
    at = at_text.try_cast(memories.schema["created_at"].dataType)
    key = id_text.try_cast(memories.schema["memory_id"].dataType)
    given = token.isNotNull() & (token != "")
    good = F.coalesce(key.isNotNull() & ((at_text == "") | at.isNotNull()), F.lit(False))
    return F.struct((~given | good).alias("ok"), F.when(given & good, at).alias("at"),
                    F.when(given & good, key).alias("id"))


def _after(key: Column) -> Column:
    """Predicate: the row stands after the key of :func:`read_token` (null ``id``: all rows)."""
    created, at = F.col("created_at"), key["at"]
    later = F.when(at.isNull(), created.isNotNull()).otherwise(created > at)
    return key["id"].isNull() | later | (created.eqNullSafe(at) & (F.col("memory_id") > key["id"]))


def clamp_page_size(n: Column) -> Column:
    return F.least(F.greatest(F.coalesce(n, F.lit(S.PAGE_SIZE_MAX)), F.lit(S.PAGE_SIZE_MIN)),
                   F.lit(S.PAGE_SIZE_MAX))


# -- 16 list_memories -------------------------------------------------------------------

def list_memories(memories: DataFrame, requests: DataFrame, where: Predicate | None = None,
                  include_content: bool = S.DEFAULT_LIST_INCLUDE_CONTENT) -> DataFrame:
    """One page per request ``request_id, space_id, page_size, next_token,
    status``. Returns the page rows with ``position``, ``total_memories`` (the
    size of this page), ``next_token`` (on every row; null on a last page) and
    the outcome. A request whose token can't be read gives one error row.
    """
    mem = filter_by_metadata(memories, where)
    req = requests.select("request_id", "space_id", clamp_page_size(F.col("page_size")).alias("_n"),
                          read_token(F.col("next_token"), memories).alias("_key"), F.col("status").alias("_st"))
    # one job over the requests: the bounds of the broadcasts and of the pages
    st = req.agg(F.count(F.lit(1)).alias("n"), F.max("_n").alias("k"), F.count_if(~F.col("_key.ok")).alias("bad")).first()
    small, largest = st["n"] <= MAX_BROADCAST_ROWS, st["k"] or S.PAGE_SIZE_MIN
    good = req.where("_key.ok")
    contents = [c for c in CONTENT_COLS if c in memories.columns]
    attach = include_content and bool(contents)
    # contents don't travel through the ranking
    j = mem.drop(*CONTENT_COLS).join(F.broadcast(good) if small else good, "space_id")
    j = j.where(_after(F.col("_key")))
    j = j.where(F.col("_st").isNull() | (F.col("_st") == "") | (status_of() == F.col("_st")))
    if attach:
        j = j.select("request_id", "space_id", "memory_id", "created_at", "_n")
    w = Window.partitionBy("request_id").orderBy("created_at", "memory_id")
    by_req = Window.partitionBy("request_id")
    # the literal bound lets Spark plan a partial WindowGroupLimit before the shuffle: a hot space
    # sends at most that many rows per task. The row after the page tells whether there is a next one
    spark = memories.sparkSession
    if int(spark.conf.get(GROUP_LIMIT)) <= S.PAGE_SIZE_MAX:
        spark.conf.set(GROUP_LIMIT, str(S.PAGE_SIZE_MAX + 1))
    ranked = j.withColumn("position", F.row_number().over(w)).where(F.col("position") <= largest + 1)
    page = ranked.withColumn("_avail", F.count(F.lit(1)).over(by_req)).where(F.col("position") <= F.col("_n"))
    last = F.max_by(F.struct("created_at", "memory_id"), F.col("position")).over(by_req)
    page = page.withColumn("next_token", F.when(F.col("_avail") > F.col("_n"),
                                                page_token(last["created_at"], last["memory_id"])))
    page = page.withColumn("total_memories", F.count(F.lit(1)).over(by_req))
    page = page.drop("_n", "_key", "_st", "_avail")
    if attach:
        # at most n * largest page rows of ids: below the bound the memories are scanned, not shuffled
        few = st["n"] * largest <= MAX_BROADCAST_ROWS
        page = page.drop("created_at")
        page = mem.join(F.broadcast(page) if few else page, ["space_id", "memory_id"])
    page = page.withColumn("error", F.lit(None).cast("string"))
    if st["bad"]:
        bad = req.where("not _key.ok").select("request_id", "space_id", F.lit(S.MSG_BAD_TOKEN).alias("error"))
        page = page.unionByName(bad, allowMissingColumns=True)
    return page.withColumn("success", F.col("error").isNull())


def page_memories(memories: DataFrame, space_id: str, page_size: int = 100,
                  next_token: str | None = None) -> DataFrame:
    """One keyset page of one space, as :func:`list_memories` gives it."""
    text = lambda v: F.lit(v).cast("string")
    req = memories.sparkSession.range(1).select(
        text("page").alias("request_id"), text(space_id).alias("space_id"), F.lit(page_size).alias("page_size"),
        text(next_token).alias("next_token"), text(None).alias("status"))
    page = list_memories(memories.where(F.col("space_id") == space_id), req, include_content=True)
    return page.drop("request_id", "total_memories")


def page_all(memories: DataFrame, page_size: int = 100, partitions: int | None = None) -> DataFrame:
    """Every memory with its page number and position within its space, as the
    keyset pages would return them; ``next_token`` on the last row of each page
    that has a successor.

    Scales with a hot space: rows are range-partitioned on (space, created_at,
    memory_id) and numbered inside each range partition. That is written once;
    the row counts of the earlier partitions of a space (a small table), by which
    the numbers are shifted, come from what was written.
    """
    n = max(S.PAGE_SIZE_MIN, min(page_size, S.PAGE_SIZE_MAX))
    spark = memories.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = (memories.select("space_id", "memory_id", "created_at")
             .repartitionByRange(parts, "space_id", "created_at", "memory_id")
             .withColumn("_pid", F.spark_partition_id()))
    local = Window.partitionBy("_pid", "space_id").orderBy("created_at", "memory_id")
    keyed = materialized(keyed.withColumn("_local", F.row_number().over(local)))
    counts = keyed.groupBy("space_id", "_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy("space_id").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
               .withColumn("_total", F.sum("_cnt").over(Window.partitionBy("space_id")))
               .select(F.col("space_id").alias("_space"), F.col("_pid").alias("_part"), "_off", "_total"))
    j = keyed.join(offsets, F.col("space_id").eqNullSafe(F.col("_space")) & (F.col("_pid") == F.col("_part")))
    pos = (F.col("_off") + F.col("_local")).cast("long")
    j = j.withColumn("position", pos).withColumn("page_no", ((pos - 1) / n).cast("long"))
    is_last = ((F.col("position") % n) == 0) & (F.col("position") < F.col("_total"))
    j = j.withColumn("next_token", F.when(is_last, page_token(F.col("created_at"), F.col("memory_id"))))
    return j.select("space_id", "memory_id", "created_at", "page_no", "position", "next_token")


# -- 11 / 20 get_memory -------------------------------------------------------------------

def negotiate_content(content_type: Column, content: Column) -> Column:
    """``struct<content_kind, content, content_error>``: JSON content types are
    parsed (kept as canonical JSON text), everything else is a string."""
    is_json = F.coalesce(content_type, F.lit("")).contains("application/json")
    parsed = strict_parse_json(content)
    bad = is_json & content.isNotNull() & parsed.isNull()
    return F.struct(
        F.when(is_json, F.lit("json")).otherwise(F.lit("string")).alias("content_kind"),
        F.when(is_json, F.to_json(parsed)).otherwise(content).alias("content"),
        F.when(bad, F.concat(F.lit(S.MSG_CONTENT_PREFIX), F.lit("invalid JSON content")))
        .alias("content_error"),
    )


def get_memories(requests: DataFrame, memories: DataFrame,
                 include_content: bool = S.DEFAULT_GET_INCLUDE_CONTENT) -> DataFrame:
    """One row per requested ``memory_id``: the memory (and its content through
    content negotiation when asked), or an error row."""
    mem = memories.withColumn("_found", F.lit(True))
    if not include_content:
        mem = mem.drop(*CONTENT_COLS)
    mem = reduce_to_keys(mem, requests, "memory_id")
    j = requests.select("memory_id").join(mem, "memory_id", "left")
    if include_content:
        # decoded and parsed above the join: only for the memories asked for
        stored = F.coalesce(F.col("original_content"),
                            F.make_valid_utf8(F.unbase64(F.col("original_content_b64")).cast("string")))
        neg = F.when(F.col("_found"), negotiate_content(F.col("content_type"), stored))
        j = j.withColumn("_neg", neg).select("*", "_neg.*").drop("_neg", *CONTENT_COLS)
    err = first_error((F.col("_found").isNull(),
                       F.concat(F.lit(S.MSG_MEMORY_NOT_FOUND), F.col("memory_id").cast("string"))))
    return with_outcome(j, err).drop("_found")
