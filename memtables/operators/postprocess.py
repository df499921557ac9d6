"""Post-processing of retrieval results: rerank (36), relevance threshold (22),
cut to k, chronological resort (37), memory index (31), totals (32), the
summary's input (33), and the whole chain (38).

Everything after top-k works on at most k rows per query, so each step is a
window over ``query_id`` on a small table; the joins that attach creation times
have the small result side and let AQE broadcast it. Texts don't travel through
the windows: found chunks are written once with a number, and results take
their texts by it at the end.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from memtables import schema as S
from memtables.functions.text import sha_id, tokens
from memtables.operators import retrieval as R
from memtables.operators import sizing as SZ
from memtables.operators.outcomes import first_error, with_outcome
from memtables.operators.sizing import scan_bytes
from memtables.operators.summary import with_reply
from memtables.session import materialized


# -- 36 rerankers ------------------------------------------------------------

@dataclass(frozen=True)
class Reranker:
    """``score(prepared_query, prepared_chunk) -> Column``. ``prepare`` (text ->
    Column) runs once per query and once per distinct chunk, not per pair;
    without it the raw texts are scored."""
    score: Callable[[Column, Column], Column]
    prepare: Callable[[Column], Column] | None = None


def jaccard_sets(a: Column, b: Column) -> Column:
    """|A and B| / |A or B| of two distinct-token arrays (0 when both empty).
    The intersection size is computed once and carried by a lambda variable."""
    inter = F.array(F.size(F.array_intersect(a, b)))
    return F.transform(inter, lambda i: F.when(
        F.size(a) + F.size(b) - i > 0, i / (F.size(a) + F.size(b) - i)).otherwise(F.lit(0.0)))[0]


def jaccard(query_text: Column, chunk_text: Column) -> Column:
    """Token-set overlap of query and chunk text (our built-in reranker)."""
    return jaccard_sets(tokens(query_text), tokens(chunk_text))


RERANKERS: dict[str, Reranker] = {"jaccard": Reranker(score=jaccard_sets, prepare=tokens)}


def register_reranker(name: str, score: Callable[[Column, Column], Column],
                      prepare: Callable[[Column], Column] | None = None) -> None:
    """Plug in a reranker: Column functions or pandas UDFs."""
    RERANKERS[name] = Reranker(score=score, prepare=prepare)


def _prepared(text_col: str, prefix: str, asked: Callable[[int, str], Column]) -> list[Column]:
    """The rerankers' inputs from a text, each only where ``asked`` (number, name) holds."""
    out = []
    for i, (name, rr) in enumerate(RERANKERS.items()):
        text = F.coalesce(F.col(text_col), F.lit(""))
        val = rr.prepare(text) if rr.prepare is not None else text
        out.append(F.when(asked(i, name), val).alias(f"{prefix}{i}"))
    return out


def _unknown_reranker() -> Column:
    given = F.coalesce(F.col("reranker_id"), F.lit(""))
    return (given != "") & ~given.isin(*RERANKERS)


def rerank_score(reranker_id: Column, query_text: Column, chunk_text: Column) -> Column:
    """Score of the named reranker on raw texts (null for an unknown name)."""
    expr = F.lit(None).cast("double")
    for name, rr in RERANKERS.items():
        q = rr.prepare(query_text) if rr.prepare is not None else query_text
        c = rr.prepare(chunk_text) if rr.prepare is not None else chunk_text
        expr = F.when(reranker_id == name, rr.score(q, c).cast("double")).otherwise(expr)
    return F.round(expr, S.SCORE_DIGITS)


def post_processor_on() -> Column:
    """The chain runs when any of the five options is given (even ``false``)."""
    return (F.coalesce(F.col("reranker_id"), F.lit("")) != "") \
        | (F.coalesce(F.col("llm_id"), F.lit("")) != "") \
        | F.col("relevance_threshold").isNotNull() \
        | F.col("llm_temperature").isNotNull() \
        | F.col("chronological_resort").isNotNull()


# -- 38 the chain ------------------------------------------------------------

MAX_BROADCAST_RESULTS = 2_000_000   # found ids allowed in a broadcast id set


def _only_found(table: DataFrame, top: DataFrame, key: str) -> DataFrame:
    """The rows of ``table`` that the results name, by a broadcast semi-join where their ids are few."""
    ids = top.select(key).distinct()
    if ids.limit(MAX_BROADCAST_RESULTS + 1).count() > MAX_BROADCAST_RESULTS:
        return table
    return table.join(F.broadcast(ids), key, "left_semi")


def retrieve_postprocessed(requests: DataFrame, chunk_vectors: DataFrame, chunk_texts: DataFrame,
                           memories: DataFrame, *, method: str = "auto") -> DataFrame:
    """top-k -> rerank -> threshold -> cut to k -> resort, with memory index and
    totals. One row per result: query_id, rank, chunk_id, memory_id, space_id,
    relevance_score, memory_index, total_results, created_at, chunk_text.
    Requests in error (:func:`retrieval_outcomes`) have no results.

    The search runs once: its few rows are written, and everything after reads
    them. Texts are read and tokenised once per found chunk, and where the tables
    are small, on all cores; they are written with a number, which stands for the text until the
    results are ranked and cut."""
    requests = requests.where(~_unknown_reranker())
    top = materialized(R.retrieve_topk(requests, chunk_vectors, method=method))
    opts = SZ.spread(requests.select(
        "query_id", "query_text", "max_results", "relevance_threshold", "reranker_id", "chronological_resort",
        post_processor_on().alias("_post")))
    opts = opts.select(*(c for c in opts.columns if c != "query_text"),
                       *_prepared("query_text", "_q", lambda i, name: F.col("reranker_id") == name))
    texts = chunk_texts.select("chunk_id", "chunk_text")
    created = memories.select("memory_id", "created_at")
    if scan_bytes(texts) + scan_bytes(created) > SZ.SEMI_JOIN_REDUCTION_BYTES:
        # big text / memory tables and few found ids: those cut the big tables down with
        # broadcast semi-joins, so the tables are scanned but never shuffled to meet a small result set
        texts, created = _only_found(texts, top, "chunk_id"), _only_found(created, top, "memory_id")
    asked = (top.join(requests.select("query_id", "reranker_id"), "query_id").groupBy("chunk_id")
             .agg(*(F.coalesce(F.bool_or(F.col("reranker_id") == name), F.lit(False)).alias(f"_a{i}")
                    for i, name in enumerate(RERANKERS))))
    found = SZ.spread(asked.join(texts, "chunk_id", "left"))
    found = materialized(found.select("chunk_id", "chunk_text", F.monotonically_increasing_id().alias("_text"),
                                      *_prepared("chunk_text", "_c", lambda i, name: F.col(f"_a{i}"))))
    j = top.join(opts, "query_id").join(found.drop("chunk_text"), "chunk_id", "left")
    rr = F.lit(None).cast("double")
    for i, (name, r) in enumerate(RERANKERS.items()):
        rr = F.when(F.col("reranker_id") == name,
                    r.score(F.col(f"_q{i}"), F.col(f"_c{i}")).cast("double")).otherwise(rr)
    j = j.withColumn("_rr", F.when(F.col("_post"), F.round(rr, S.SCORE_DIGITS)))
    j = j.drop(*(f"{side}{i}" for side in ("_q", "_c") for i in range(len(RERANKERS)))).join(created, "memory_id", "left")
    reranked = F.col("_rr").isNotNull()
    j = j.withColumn("relevance_score", F.coalesce(F.col("_rr"), F.col("score")))
    by_q = Window.partitionBy("query_id")
    j = j.withColumn("_order", F.row_number().over(by_q.orderBy(
        F.when(reranked, F.col("relevance_score")).desc_nulls_last(),
        F.when(reranked, F.col("chunk_id")).asc_nulls_last(),
        F.col("rank"))))
    # threshold: drop below, keep equal; then cut to k
    j = j.where(~F.col("_post") | F.col("relevance_threshold").isNull()
                | (F.col("relevance_score") >= F.col("relevance_threshold")))
    j = j.withColumn("_order", F.row_number().over(by_q.orderBy("_order")))
    k = F.coalesce(F.col("max_results"), F.lit(S.DEFAULT_MAX_RESULTS))
    j = j.where(F.col("_order") <= k)
    resort = F.col("_post") & F.coalesce(F.col("chronological_resort"), F.lit(False))
    j = j.withColumn("rank", F.row_number().over(by_q.orderBy(
        F.when(resort, F.col("created_at")).asc_nulls_last(),
        F.when(resort, F.col("chunk_id")).asc_nulls_last(),
        F.col("_order"))))
    j = R.memory_index(j, "rank")
    j = j.withColumn("total_results", F.count(F.lit(1)).over(by_q))
    j = j.join(found.select("_text", "chunk_text"), "_text", "left")
    return j.select("query_id", "rank", "chunk_id", "memory_id", "space_id", "relevance_score",
                    "memory_index", "total_results", "created_at", "chunk_text")


# -- 32 result_totals --------------------------------------------------------

def result_totals(results: DataFrame, requests: DataFrame) -> DataFrame:
    """Per request: total_results, total_memories (0 when nothing matched)."""
    agg = results.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("total_results"),
        F.count_distinct("memory_id").alias("total_memories"))
    return (requests.select("query_id").join(agg, "query_id", "left")
            .select("query_id",
                    F.coalesce("total_results", F.lit(0)).cast("long").alias("total_results"),
                    F.coalesce("total_memories", F.lit(0)).cast("long").alias("total_memories")))


# -- 33 abstract_context ------------------------------------------------------

CONTEXT_SEPARATOR = "\n\n"


def abstract_context(results: DataFrame, chunk_texts: DataFrame | None = None) -> DataFrame:
    """Per query: the found chunk texts in rank order, joined (the summary's
    input), and an extractive reply, the most central of their sentences
    (``summary.with_reply``). Bounded: a query holds at most k results. They are shuffled once with their
    texts, by query."""
    res = results
    if "chunk_text" not in res.columns:
        res = res.join(chunk_texts.select("chunk_id", "chunk_text"), "chunk_id", "left")
    items = F.array_sort(F.collect_list(F.struct("rank", F.coalesce("chunk_text", F.lit("")).alias("t"))))
    g = with_reply(res.repartition("query_id").groupBy("query_id").agg(items.alias("_items")), F.col("_items")["t"])
    return g.select(
        "query_id",
        F.array_join(F.transform("_items", lambda x: x["t"]), CONTEXT_SEPARATOR).alias("context"),
        F.coalesce("abstract_reply", F.lit("")).alias("abstract_reply"),
        F.size("_items").cast("long").alias("n_chunks"),
    )


# -- the result-set envelope (one row per request) ------------------------------------

def retrieval_outcomes(requests: DataFrame) -> DataFrame:
    """``query_id`` and outcome per request: an error for a request without a valid space id,
    without a usable query vector (null, empty or zero), or with an unknown reranker."""
    usable = F.coalesce(F.exists("query_vector", lambda x: F.coalesce(x != 0, F.lit(False))), F.lit(False))
    err = first_error(
        (F.size(R.space_keys(F.col("space_ids"))) == 0, S.MSG_NO_SPACE_ID),
        (~usable, S.MSG_NO_QUERY_VECTOR),
        (_unknown_reranker(), F.concat(F.lit(S.MSG_UNKNOWN_RERANKER), F.col("reranker_id"))))
    return with_outcome(requests.select("query_id", err.alias("_err")), F.col("_err")).drop("_err")


def result_sets(results: DataFrame, requests: DataFrame, memories: DataFrame,
                freshness: DataFrame | None = None) -> DataFrame:
    """One row per request, like the reference's result envelope: the outcome,
    ``result_set_id``, ``results`` (chunk id, text, memory id, score, memory
    index; in rank order), ``memories`` (memory id, space, status, created;
    in memory-index order; none where ``include_memory_definition`` is false),
    ``total_results``, the ``query`` text, ``abstract_reply`` (where ``llm_id`` is
    given and something was found) and ``message``: with ``freshness``, nothing found in spaces still
    indexing, unless ``wait_for_indexing`` is false. Both switches are optional
    columns of ``requests``. Every group holds at most k rows of one query."""
    def switch(name: str, default: bool) -> Column:
        return F.coalesce(F.col(name), F.lit(default)) if name in requests.columns else F.lit(default)
    item = F.struct("rank", "chunk_id", "chunk_text", "memory_id", "relevance_score", "memory_index")
    res = results.repartition("query_id").groupBy("query_id").agg(F.array_sort(F.collect_list(item)).alias("_r"))
    shown = results
    if "include_memory_definition" in requests.columns:
        wanted = requests.where(switch("include_memory_definition", S.DEFAULT_INCLUDE_MEMORY_DEFINITION)).select("query_id")
        shown = results.join(wanted, "query_id", "left_semi")
    defs = R.fetch_memory_definitions(shown, memories)
    mem = defs.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct(
        "memory_index", "memory_id", F.col("memory_space_id").alias("space_id"),
        "processing_status", "created_at"))).alias("_m"))
    out = requests.select("query_id", F.col("query_text").alias("query"), (F.coalesce("llm_id", F.lit("")) != "").alias("_llm"),
                          switch("wait_for_indexing", S.DEFAULT_WAIT_FOR_INDEXING).alias("_wait")) \
        .join(retrieval_outcomes(requests), "query_id") \
        .join(mem, "query_id", "left").join(res, "query_id", "left")
    out = out.withColumn("total_results", F.when(F.col("_r").isNull(), F.lit(0)).otherwise(F.size("_r")).cast("long"))
    # the reply reads the texts that the results carry
    out = with_reply(out, F.when(F.col("_llm"), F.col("_r")["chunk_text"]))
    out = out.withColumn("abstract_reply", F.when(F.col("_llm") & (F.col("total_results") > 0), F.coalesce("abstract_reply", F.lit(""))))
    if freshness is not None:
        from memtables.streaming.indexing import wait_messages
        out = wait_messages(out, requests, freshness).withColumn("message", F.when(F.col("_wait"), F.col("message")))
    else:
        out = out.withColumn("message", F.lit(None).cast("string"))
    dropped = F.transform("_r", lambda x: x.dropFields("rank"))
    results_col = F.coalesce(dropped, F.array().cast(out.select(dropped.alias("t")).schema["t"].dataType))
    return out.select(
        "query_id", "success", "error",
        sha_id("rs", F.col("query_id")).alias("result_set_id"),
        results_col.alias("results"),
        F.coalesce(F.col("_m"), F.array().cast(out.schema["_m"].dataType)).alias("memories"),
        "total_results", "query", "abstract_reply", "message")
