"""Catalogue operators as set operations: list / get spaces (13, 14), list
embedders (15), create-or-reuse (23) with chunking configs (24), patches with
label parse / merge / replace (25-27), cascading deletes (28, 29).

Outputs are receipts plus new snapshots of the tables; Parquet has no row
updates. Per-name and per-id work is done with aggregates (map-side combine)
joined back on the key, not windows, so one hot name cannot gather all its
requests in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from memtables import schema as S
from memtables.functions.json import labels_from_json, merge_labels
from memtables.functions.text import sha_id
from memtables.operators.outcomes import first_error, with_outcome, with_total
from memtables.session import materialized


# -- 13 list_spaces / 15 list_embedders -----------------------------------------

def first_embedder(space_embedders: Column) -> Column:
    return F.get(space_embedders["embedder_id"], F.lit(0))


def list_spaces(spaces: DataFrame, ordered: bool = True) -> DataFrame:
    """All spaces with ``total_spaces``; ordered by creation time then id."""
    out = with_total(spaces, "total_spaces")
    return out.orderBy("created_at", "space_id") if ordered else out


def embedders(registry: DataFrame, spaces: DataFrame) -> DataFrame:
    """Registered embedders plus any embedder a space refers to, with the
    number of spaces using it."""
    used = (spaces.select(F.explode("space_embedders.embedder_id").alias("embedder_id"))
            .groupBy("embedder_id").agg(F.count(F.lit(1)).alias("n_spaces")))
    return (registry.join(used, "embedder_id", "full")
            .select("embedder_id", F.coalesce("name", "embedder_id").alias("name"), "dim",
                    F.coalesce("n_spaces", F.lit(0)).alias("n_spaces")))


def list_embedders(registry: DataFrame, spaces: DataFrame) -> DataFrame:
    return with_total(embedders(registry, spaces), "total_embedders")


# -- 14 get_space ----------------------------------------------------------------

def get_spaces(requests: DataFrame, spaces: DataFrame, id_col: str = "space_id") -> DataFrame:
    """One row per request: the space, or an error row when the id is unknown."""
    found = spaces.withColumn("_found", F.lit(True))
    j = requests.join(found, requests[id_col] == found["space_id"], "left").drop(found["space_id"])
    if id_col != "space_id":
        j = j.withColumnRenamed(id_col, "space_id")
    err = first_error((F.col("_found").isNull(),
                       F.concat(F.lit(S.MSG_SPACE_NOT_FOUND), F.col("space_id"))))
    return with_outcome(j, err).drop("_found")


# -- 24 chunking_config ------------------------------------------------------------

def chunking_config(strategy: Column, chunk_size: Column, chunk_overlap: Column) -> Column:
    """``struct<strategy, chunk_size, chunk_overlap, error>`` with the tool
    defaults; ``none`` drops the sizes; unknown strategy or overlap >= size is
    an error."""
    st = F.coalesce(strategy, F.lit(S.DEFAULT_CHUNKING_STRATEGY))
    size = F.coalesce(chunk_size, F.lit(S.DEFAULT_CHUNK_SIZE)).cast("int")
    ov = F.coalesce(chunk_overlap, F.lit(S.DEFAULT_CHUNK_OVERLAP)).cast("int")
    none = st == S.STRATEGY_NONE
    err = first_error(
        (~st.isin(*S.STRATEGIES), F.concat(F.lit(S.MSG_UNKNOWN_STRATEGY), st)),
        (~none & ((size <= 0) | (ov < 0) | (ov >= size)), S.MSG_BAD_OVERLAP),
    )
    return F.struct(st.alias("strategy"),
                    F.when(~none, size).alias("chunk_size"),
                    F.when(~none, ov).alias("chunk_overlap"),
                    err.alias("error"))


# -- 23 create_or_reuse_spaces -----------------------------------------------------

def new_space_id(name: Column) -> Column:
    return sha_id("space", name)


def create_or_reuse_spaces(spaces: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requests ``seq, name, embedder_id, strategy, chunk_size, chunk_overlap``
    answered as if sent one by one in ``seq`` order.

    * a space with exactly that name exists: reuse the first (by created_at,
      space_id) with its own first embedder, else the requested one;
      the requested chunking is ignored;
    * else the first request of that name with a valid config creates it, and
      later requests of that name reuse it; invalid configs before it are errors.

    New spaces take their creation time from the request's ``created_at`` if there
    is such a column, else from the clock. Returns (receipts, new spaces snapshot).
    """
    if "created_at" not in requests.columns:
        requests = requests.withColumn("created_at", F.localtimestamp())
    existing = (spaces.groupBy("name").agg(F.min(F.struct(
        "created_at", "space_id", first_embedder(F.col("space_embedders")).alias("emb"))).alias("_e"))
        .select("name", F.col("_e.space_id").alias("_ex_id"), F.col("_e.emb").alias("_ex_emb")))
    r = (requests.withColumn("_cfg", chunking_config(F.col("strategy"), F.col("chunk_size"),
                                                      F.col("chunk_overlap")))
         .join(existing, "name", "left"))
    valid_new = F.col("_ex_id").isNull() & F.col("_cfg.error").isNull()
    creators = (r.where(valid_new).groupBy("name")
                .agg(F.min(F.struct("seq", "embedder_id", "_cfg")).alias("_c"))
                .select("name", F.col("_c.seq").alias("_c_seq"), F.col("_c.embedder_id").alias("_c_emb"),
                        F.col("_c._cfg").alias("_c_cfg")))
    r = r.join(creators, "name", "left")
    reuse_ex = F.col("_ex_id").isNotNull()
    creates = F.coalesce(~reuse_ex & (F.col("seq") == F.col("_c_seq")), F.lit(False))
    reuse_new = F.coalesce(~reuse_ex & (F.col("seq") > F.col("_c_seq")), F.lit(False))
    out = r.select(
        "seq", "name",
        F.when(reuse_ex, F.col("_ex_id")).when(creates | reuse_new, new_space_id(F.col("name")))
        .alias("space_id"),
        F.when(reuse_ex, F.coalesce("_ex_emb", "embedder_id"))
        .when(reuse_new, F.col("_c_emb")).when(creates, F.col("embedder_id")).alias("embedder_id"),
        F.when(creates, F.col("_cfg.strategy")).alias("strategy"),
        F.when(creates, F.col("_cfg.chunk_size")).alias("chunk_size"),
        F.when(creates, F.col("_cfg.chunk_overlap")).alias("chunk_overlap"),
        F.when(reuse_ex | creates | reuse_new, reuse_ex | reuse_new).alias("reused"),
        F.when(~(reuse_ex | creates | reuse_new), F.col("_cfg.error")).alias("error"),
        F.col("_c_cfg"), F.col("created_at").cast("timestamp_ntz").alias("_at"),
    )
    out = out.withColumn("success", F.col("error").isNull()).withColumn(
        "message", F.when(F.col("reused"), F.lit(S.MSG_SPACE_REUSED))
        .when(F.col("success"), F.lit(S.MSG_SPACE_CREATED)))
    created = out.where(F.col("success") & ~F.col("reused")).select(
        "space_id", "name",
        F.array(F.struct(F.col("embedder_id").alias("embedder_id"))).alias("space_embedders"),
        F.struct(F.col("_c_cfg.strategy").alias("strategy"), F.col("_c_cfg.chunk_size").alias("chunk_size"),
                 F.col("_c_cfg.chunk_overlap").alias("chunk_overlap")).alias("chunking"),
        F.lit(False).alias("public_read"),
        F.create_map().cast("map<string,string>").alias("labels"),
        F.col("_at").alias("created_at"),
    )
    return out.drop("_c_cfg", "_at"), spaces.unionByName(created)


# -- 25-27 update_spaces ------------------------------------------------------------

#: patches composed at a time in one row
PATCH_BLOCK = 32


def _then(a: Column, b: Column) -> Column:
    """Change ``a``, then ``b``, as one change ``struct<name, public_read, replaced, labels>``: the last name and
    flag that are not null; labels from the last replacement on, later ones laid over earlier ones by key."""
    return F.struct(F.coalesce(b["name"], a["name"]).alias("name"), F.coalesce(b["public_read"], a["public_read"]).alias("public_read"),
                    (a["replaced"] | b["replaced"]).alias("replaced"),
                    F.when(b["replaced"], b["labels"]).otherwise(merge_labels(a["labels"], b["labels"])).alias("labels"))


def _running(changes: DataFrame, most: int) -> DataFrame:
    """``space_id, no, change`` (``no`` from 0 without gaps, below ``most``) -> each change after all before it.

    Composing is associative, so blocks of ``PATCH_BLOCK`` changes are composed each for itself, their totals
    likewise one level up, and what stands before a block is laid under it: log(most) levels, no row above a block."""
    by_no = lambda x, y: F.when(x["no"] < y["no"], -1).when(x["no"] > y["no"], 1).otherwise(0)
    first = lambda c: F.transform(F.slice(c, 1, 1), lambda x: F.struct(x["no"].alias("no"), x["change"].alias("change")))
    add = lambda acc, x: F.concat(acc, F.array(F.struct(
        x["no"].alias("no"), _then(F.element_at(acc, -1)["change"], x["change"]).alias("change"))))
    blocks = (changes.groupBy("space_id", F.floor(F.col("no") / PATCH_BLOCK).alias("block"))
              .agg(F.array_sort(F.collect_list(F.struct("no", "change")), by_no).alias("c"))
              .select("space_id", "block", F.aggregate(F.slice("c", 2, PATCH_BLOCK), first(F.col("c")), add).alias("c")))
    if most <= PATCH_BLOCK:
        return blocks.select("space_id", F.explode("c").alias("x")).select("space_id", "x.*")
    blocks = materialized(blocks)
    totals = blocks.select("space_id", F.col("block").alias("no"), F.element_at("c", -1)["change"].alias("change"))
    under = _running(totals, -(-most // PATCH_BLOCK)).select("space_id", (F.col("no") + 1).alias("block"), F.col("change").alias("under"))
    rows = blocks.join(under, ["space_id", "block"], "left").select("space_id", "under", F.explode("c").alias("x"))
    return rows.select("space_id", "x.no", F.when(F.col("under").isNull(), F.col("x.change"))
                       .otherwise(_then(F.col("under"), F.col("x.change"))).alias("change"))


def _numbered(rows: DataFrame, *order: str) -> DataFrame:
    """Adds ``no``, each row's number in its space (from 0), without a window over a whole space: numbered in
    range partitions, shifted by the counts of the earlier ones."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, "space_id", *order).withColumn("_part", F.spark_partition_id())
    rows = materialized(rows.withColumn("_no", F.row_number().over(Window.partitionBy("_part", "space_id").orderBy(*order)) - 1))
    w = Window.partitionBy("space_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = (rows.groupBy("space_id", "_part").agg(F.count(F.lit(1)).alias("n"))
              .select("space_id", "_part", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("_before")))
    return rows.join(before, ["space_id", "_part"]).withColumn("no", (F.col("_no") + F.col("_before")).cast("long")).drop("_part", "_no", "_before")


def update_spaces(spaces: DataFrame, patches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Patches ``space_id, name, public_read, replace_labels_json,
    merge_labels_json`` (null = leave alone), answered as if sent one by one in
    order of the column ``seq`` (distinct numbers; without it, at most one per
    space). A patch in error changes nothing. Embedders and chunking never change.
    Patches are composed in blocks (:func:`_running`), so one space's patches spread over tasks.
    Returns (receipts with the state after each patch, new snapshot)."""
    numbered = "seq" in patches.columns
    p = patches if numbered else patches.withColumn("seq", F.lit(0))
    p = (p.withColumn("seq", F.col("seq").cast("long"))
         .withColumn("_rep", labels_from_json(F.col("replace_labels_json")))
         .withColumn("_mrg", labels_from_json(F.col("merge_labels_json"))))
    j = p.join(spaces.select("space_id", F.lit(True).alias("_found")), "space_id", "left")
    err = first_error(
        (F.col("_found").isNull(), F.concat(F.lit(S.MSG_SPACE_NOT_FOUND), F.coalesce("space_id", F.lit("null")))),
        (F.col("_rep.error").isNotNull(), F.col("_rep.error")),
        (F.col("_mrg.error").isNotNull(), F.col("_mrg.error")),
        (F.col("_rep.labels").isNotNull() & F.col("_mrg.labels").isNotNull(), S.MSG_LABELS_EXCLUSIVE),
    )
    j = materialized(j.select("space_id", "seq", "name", "public_read", F.col("_rep.labels").alias("replace"),
                              F.col("_mrg.labels").alias("merge"), err.alias("_err")))
    good = j.where("_err is null")
    change = lambda replaced, labels: F.struct(F.col("name"), F.col("public_read"), replaced.alias("replaced"), labels.alias("labels"))
    # the space as it is comes first, as a change of everything
    start = spaces.join(good.select("space_id").distinct(), "space_id", "left_semi").select(
        "space_id", F.lit(0).alias("_step"), F.lit(None).cast("long").alias("seq"), change(F.lit(True), F.col("labels")).alias("change"))
    steps = _numbered(start.unionByName(good.select(
        "space_id", F.lit(1).alias("_step"), "seq",
        change(F.col("replace").isNotNull(), F.coalesce("replace", "merge")).alias("change"))), "_step", "seq")
    most = steps.agg(F.max("no")).first()[0]
    done = materialized(_running(steps.select("space_id", "no", "change"), (most or 0) + 1)
                        .join(steps.select("space_id", "no", "_step", "seq"), ["space_id", "no"])
                        .select("space_id", "no", "_step", "seq", "change.*"))
    bad = j.where("_err is not null").select("space_id", "seq", "_err")
    receipts = done.where("_step = 1").select("space_id", "seq", "name", "public_read", "labels", F.lit(None).cast("string").alias("_err"))
    receipts = with_outcome(receipts.unionByName(bad, allowMissingColumns=True), F.col("_err"), S.MSG_SPACE_UPDATED).drop("_err")
    last = done.groupBy("space_id").agg(F.max_by(F.struct("name", "public_read", "labels"), "no").alias("_new"))
    kept = [c for c in spaces.columns if c not in ("name", "public_read", "labels")]
    state = lambda c: F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col(c)).alias(c)
    snap = spaces.join(last, "space_id", "left").select(*kept, state("name"), state("public_read"), state("labels"))
    return (receipts if numbered else receipts.drop("seq")), snap.select(*spaces.columns)


def parse_labels(df: DataFrame, col: str) -> DataFrame:
    """Adds ``labels`` (map) and the outcome columns for a JSON text column."""
    p = df.withColumn("_lab", labels_from_json(F.col(col)))
    return with_outcome(p.withColumn("labels", F.col("_lab.labels")), F.col("_lab.error")).drop("_lab")


# -- 28 / 29 cascading deletes --------------------------------------------------------

def delete_spaces(requests: DataFrame, spaces: DataFrame, memories: DataFrame,
                  chunks: DataFrame | None = None, vectors: DataFrame | None = None):
    """Removes spaces and everything in them. Returns (receipts with the number
    of memories removed, spaces, memories, chunks, vectors)."""
    req = requests.select("space_id").distinct()
    known = req.join(spaces.select("space_id"), "space_id", "left_semi")
    gone_mem = memories.join(known, "space_id", "left_semi").select("memory_id", "space_id")
    counts = gone_mem.groupBy("space_id").agg(F.count(F.lit(1)).alias("deleted_memories"))
    rec = (req.join(known.withColumn("_found", F.lit(True)), "space_id", "left")
           .join(counts, "space_id", "left"))
    rec = with_outcome(rec.select("space_id", "_found",
                                  F.coalesce("deleted_memories", F.lit(0)).alias("deleted_memories")),
                       first_error((F.col("_found").isNull(),
                                    F.concat(F.lit(S.MSG_SPACE_NOT_FOUND), F.col("space_id")))),
                       S.MSG_SPACE_DELETED).drop("_found")
    spaces2 = spaces.join(known, "space_id", "left_anti")
    memories2 = memories.join(known, "space_id", "left_anti")
    ids = gone_mem.select("memory_id")

    def cascade(df: DataFrame | None) -> DataFrame | None:
        # rows of the deleted memories, and rows filed under a deleted space
        if df is None:
            return None
        out = df.join(ids, "memory_id", "left_anti")
        return out.join(known, "space_id", "left_anti") if "space_id" in df.columns else out

    return rec, spaces2, memories2, cascade(chunks), cascade(vectors)


def delete_memories(requests: DataFrame, memories: DataFrame, chunks: DataFrame | None = None,
                    vectors: DataFrame | None = None):
    """Removes memories, their chunks and vectors. Returns (receipts with the
    number of vectors removed, memories, chunks, vectors)."""
    req = requests.select("memory_id").distinct()
    known = req.join(memories.select("memory_id"), "memory_id", "left_semi")
    rec = req.join(known.withColumn("_found", F.lit(True)), "memory_id", "left")
    if vectors is not None:
        vc = (vectors.join(known, "memory_id", "left_semi")
              .groupBy("memory_id").agg(F.count(F.lit(1)).alias("deleted_vectors")))
        rec = rec.join(vc, "memory_id", "left")
    else:
        rec = rec.withColumn("deleted_vectors", F.lit(None).cast("long"))
    rec = with_outcome(
        rec.select("memory_id", "_found",
                   F.when(F.col("_found"), F.coalesce("deleted_vectors", F.lit(0))).alias("deleted_vectors")),
        first_error((F.col("_found").isNull(),
                     F.concat(F.lit(S.MSG_MEMORY_NOT_FOUND), F.col("memory_id").cast("string")))),
        S.MSG_MEMORY_DELETED).drop("_found")
    memories2 = memories.join(known, "memory_id", "left_anti")
    chunks2 = chunks.join(known, "memory_id", "left_anti") if chunks is not None else None
    vectors2 = vectors.join(known, "memory_id", "left_anti") if vectors is not None else None
    return rec, memories2, chunks2, vectors2
