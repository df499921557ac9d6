"""Streaming indexing (44), freshness and waiting (46).

Memories are chunked and embedded as they arrive (Structured Streaming). A keyed state store
(``transformWithState``) holds the status of every memory, so the cost of a batch depends on
what arrives, not on what was ever indexed:

* PENDING: not seen yet. A memory that fits moves to PROCESSING and is indexed by the batch; one that
  doesn't (no text) moves to FAILED.
* FAILED: sent again, it is tried again.
* PROCESSING / COMPLETED: rows that arrive again are replays and dropped. There is no watermark, so
  memories may arrive however late.
* A memory for whose chunks the embedder gave no vector is FAILED too. Its row goes to ``retry``, which
  the stream reads like a source: it is tried again, ``max_attempts`` times in all, and after that whenever it
  is sent again.

Each micro-batch writes vectors and status rows into folders keyed by batch id, overwriting
that batch's folders, so a batch replayed after a failure writes the same rows again
instead of adding some. Readers see a memory's vectors once its COMPLETED row stands.

Searching beside the running stream, with a deadline: :mod:`memtables.streaming.waiting`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from memtables import schema as S
from memtables.operators import chunking as CH
from memtables.operators.embedding import embed_chunks
from memtables.session import materialized, shared_dir

Chunker = Callable[[DataFrame], DataFrame]


def fixed_chunker(memories: DataFrame) -> DataFrame:
    return CH.chunk_fixed(memories, S.DEFAULT_CHUNK_SIZE, S.DEFAULT_CHUNK_OVERLAP)


def default_chunker(memories: DataFrame) -> DataFrame:
    """The tool's default strategy and sizes."""
    return CH.chunk_recursive(memories, S.DEFAULT_CHUNK_SIZE, S.DEFAULT_CHUNK_OVERLAP)


def space_chunker(spaces: DataFrame) -> Chunker:
    """Chunk every memory with its space's chunking config (as the server
    would); spaces without a config fall back to the tool defaults."""
    return lambda memories: CH.chunk_by_config(memories, spaces)


def _has_text() -> Column:
    return F.col("original_content").isNotNull() & (F.col("original_content") != "")


def batch_vectors(memories: DataFrame, chunker: Chunker = default_chunker, embedder_id: str = "hash-256") -> DataFrame:
    """The chunks, with vectors, of one batch's memories with text."""
    return embed_chunks(chunker(memories.where(_has_text())), embedder_id)


# -- the state of a memory ----------------------------------------------------------------

class MemoryStates(StatefulProcessor):
    """Lets the rows through that are to be indexed or failed, with the number of the attempt.

    Of several rows of a memory in one batch the first that can be indexed is taken (by creation time, then
    text), else the first. Rows are looked at one by one, so a memory sent a million times holds one row."""

    def __init__(self, max_attempts: int):
        self.max_attempts = max_attempts

    def init(self, handle) -> None:
        self.state = handle.getValueState("memory", "status string, attempt int")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        status, attempt = self.state.get() or (S.STATUS_PENDING, 0)
        first = order = again = None
        for r in rows:
            if r.attempt is not None:                       # sent back by an earlier batch
                if status == S.STATUS_PROCESSING and r.attempt == attempt:
                    again = r
                continue
            place = (r.error is not None, r.created_at is not None, str(r.created_at), r.original_content or "")
            if order is None or place < order:
                first, order = r, place
        if again is not None and attempt < self.max_attempts:
            first = again
        elif again is not None:
            status = S.STATUS_FAILED
            self.state.update((status, attempt))
        if first is None or (status == S.STATUS_PROCESSING and first is not again):
            return
        self.state.update((S.STATUS_FAILED if first.error else S.STATUS_PROCESSING, attempt + 1))
        yield Row(memory_id=key[0], space_id=first.space_id, original_content=first.original_content,
                  created_at=first.created_at, attempt=attempt + 1, error=first.error)

    def close(self) -> None:
        pass


_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _status(rows: DataFrame, status: Column, n_chunks: Column, error: Column) -> DataFrame:
    return rows.select("memory_id", "space_id", status.alias("processing_status"),
                       n_chunks.cast("long").alias("n_chunks"), error.cast("string").alias("error"), "attempt")


def stream_index_memories(stream: DataFrame, out_dir: str, checkpoint: str,
                          chunker: Chunker = default_chunker, embedder_id: str = "hash-256", *,
                          max_attempts: int = 3, trigger: dict | None = None) -> StreamingQuery:
    """Starts the indexing stream over a streaming DataFrame of memories (``memory_id, space_id,
    original_content, created_at``; other columns of any type are left out); returns the StreamingQuery.
    ``trigger``: arguments of ``DataStreamWriter.trigger`` (default: what is there now). Under ``out_dir``:
    ``vectors/batch_id=<n>``, ``status/batch_id=<n>/phase=<0 processing, 1 done>`` and ``retry/batch_id=<n>``;
    read them with :func:`indexed_vectors` and :func:`latest_status`."""
    spark = stream.sparkSession
    row = T.StructType([stream.schema[c] for c in ("memory_id", "space_id", "original_content", "created_at")]
                       + [T.StructField("attempt", T.IntegerType()), T.StructField("error", T.StringType())])
    invalid = F.when(F.col("memory_id").isNull(), S.MSG_NO_MEMORY_ID).when(~_has_text(), S.MSG_NO_TEXT)
    fresh = stream.select(*row.names[:4], F.lit(None).cast("int").alias("attempt"), invalid.alias("error"))
    _make_folder(spark, f"{out_dir}/retry")
    back = spark.readStream.schema(row).parquet(f"{out_dir}/retry").select(*row.names)
    states = fresh.unionByName(back).groupBy("memory_id").transformWithState(MemoryStates(max_attempts), row, "update", "none")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        vectors, status = f"{out_dir}/vectors/batch_id={batch_id}", f"{out_dir}/status/batch_id={batch_id}"
        new = materialized(batch)                           # the state store is asked once
        todo = new.where("error is null")
        _status(todo, F.lit(S.STATUS_PROCESSING), F.lit(0), F.lit(None)).write.mode("overwrite").parquet(f"{status}/phase=0")
        found = batch_vectors(todo.select(*row.names[:4]), chunker, embedder_id)
        found.withColumn("usable", F.col("embedding").isNotNull()).write.mode("overwrite").parquet(vectors)
        per = session.read.parquet(vectors).groupBy("memory_id").agg(
            F.count(F.lit(1)).alias("n"), F.bool_and("usable").alias("whole"))
        done = new.join(per, "memory_id", "left")
        error = F.coalesce("error", F.when(~F.col("whole"), F.lit(S.MSG_NOT_EMBEDDED)))
        ok = error.isNull()
        _status(done, F.when(ok, S.STATUS_COMPLETED).otherwise(S.STATUS_FAILED),
                F.when(ok, F.coalesce("n", F.lit(0))).otherwise(0), error).write.mode("overwrite").parquet(f"{status}/phase=1")
        failed = session.read.parquet(f"{status}/phase=1").where(F.col("error") == S.MSG_NOT_EMBEDDED).select("memory_id")
        if not failed.isEmpty():
            todo.join(failed, "memory_id", "left_semi").select(*row.names).write.mode("overwrite").parquet(
                f"{out_dir}/retry/batch_id={batch_id}")

    before = spark.conf.get(_STATE_STORE, None)
    spark.conf.set(_STATE_STORE, _ROCKSDB)                  # read when the query starts
    try:
        return (states.writeStream.outputMode("update").foreachBatch(write_batch)
                .option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"availableNow": True}))
                .start())
    finally:
        if before is None:
            spark.conf.unset(_STATE_STORE)
        else:
            spark.conf.set(_STATE_STORE, before)


def has_batches(spark: SparkSession, out_dir: str) -> bool:
    """Whether a batch has been done, so that statuses and vectors can be read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out_dir}/status/batch_id=*/phase=1/_SUCCESS")
    found = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(path)
    return found is not None and len(found) > 0


def latest_status(spark: SparkSession, out_dir: str) -> DataFrame:
    """One row per memory seen: its status, chunks, error and number of attempts. What no batch has taken up
    yet is PENDING and has no row."""
    rows = spark.read.parquet(f"{out_dir}/status")
    value = F.struct("space_id", "processing_status", "n_chunks", "error", "attempt", "batch_id")
    last = rows.groupBy("memory_id").agg(F.max_by(value, F.struct("attempt", "batch_id", "phase")).alias("s"))
    return last.select("memory_id", "s.*")


def indexed_vectors(spark: SparkSession, out_dir: str) -> DataFrame:
    """The vectors of COMPLETED memories, each from the batch that completed it."""
    done = spark.read.parquet(f"{out_dir}/status").where((F.col("phase") == 1) & (F.col("processing_status") == S.STATUS_COMPLETED))
    vectors = spark.read.parquet(f"{out_dir}/vectors")
    return vectors.join(done.select("batch_id", "memory_id"), ["batch_id", "memory_id"], "left_semi").drop("batch_id", "usable")


def _make_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).mkdirs(p)


def documents_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New documents arriving as files in ``sf_dir`` (file source), joined with
    their creation events (stream-static join) into memory rows."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").schema
    # the table's own path, a single file or a folder of part files: a stream takes a file only by a pattern
    docs = spark.readStream.schema(schema).option("maxFilesPerTrigger", 8).parquet(f"{sf_dir.rstrip('/')}/documents.parque[t]")
    ev = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").select("event_id", "ts")
    return docs.join(ev, docs.doc_id == ev.event_id).select(
        F.col("doc_id").alias("memory_id"), F.col("source").alias("space_id"),
        F.col("text").alias("original_content"), F.col("ts").alias("created_at"))


def run_to_completion(spark: SparkSession, make_stream: Callable[[SparkSession], DataFrame],
                      **kw) -> tuple[SparkSession, str]:
    """Runs the indexing stream until the available input is drained; returns
    the session it ran in and the output folder (in the shared checkpoint
    folder).

    The stream runs in a child session (same SparkContext) whose shuffle
    partitions equal the cluster's cores: streaming state keeps the partition
    count it starts with and is not coalesced, and the caller's session
    settings stay untouched."""
    root = shared_dir(spark, "indexing")
    child = spark.newSession()
    child.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    drain(stream_index_memories(make_stream(child), f"{root}/out", f"{root}/checkpoint", **kw))
    return child, f"{root}/out"


def drain(query: StreamingQuery) -> None:
    """Waits until a stream over what is available has ended; raises if it failed."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


# -- 46 indexing_freshness --------------------------------------------------------------

UNFINISHED = (S.STATUS_PENDING, S.STATUS_PROCESSING)


def indexing_freshness(memories: DataFrame) -> DataFrame:
    """Per space and status: number of memories (null status = PENDING)."""
    st = F.coalesce(F.col("processing_status"), F.lit(S.STATUS_PENDING))
    return (memories.groupBy("space_id", st.alias("processing_status"))
            .agg(F.count(F.lit(1)).alias("n_memories"))
            .withColumn("unfinished", F.col("processing_status").isin(*UNFINISHED)))


def wait_messages(totals: DataFrame, requests: DataFrame, freshness: DataFrame) -> DataFrame:
    """Adds ``message`` to per-query totals: a query with no results over
    spaces still holding unfinished memories gets the "may still be
    processing" message (the timed-out wait of the client)."""
    from memtables.operators.retrieval import restrict_to_spaces
    busy = freshness.where("unfinished").select("space_id").distinct()
    waiting = (restrict_to_spaces(requests).join(busy, "space_id", "left_semi")
               .select("query_id").distinct().withColumn("_busy", F.lit(True)))
    return (totals.join(waiting, "query_id", "left")
            .withColumn("message", F.when((F.col("total_results") == 0) & F.col("_busy"),
                                          F.lit(S.MSG_STILL_PROCESSING)))
            .drop("_busy"))
