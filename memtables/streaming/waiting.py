"""Searching while memories are still being indexed (46).

The client repeats an empty search every two seconds until ten have passed, and says so when time ran out.
Here a table of requests is searched beside the running indexing stream. A listener
wakes the search whenever the stream has done a batch (the poll interval is only the longest nap),
and every round searches for the requests that are still open.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from memtables import schema as S
from memtables.operators.retrieval import restrict_to_spaces
from memtables.session import materialized
from memtables.streaming import indexing as IX


class Progress(StreamingQueryListener):
    """Counts the batches that the streams of a session have done."""

    def __init__(self):
        self.turn = threading.Condition()
        self.n = 0

    def _advance(self) -> None:
        with self.turn:
            self.n += 1
            self.turn.notify_all()

    def wait(self, seen: int, seconds: float) -> None:
        """Until more than ``seen`` batches are done, at most ``seconds``."""
        with self.turn:
            self.turn.wait_for(lambda: self.n > seen, seconds)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.numInputRows:
            self._advance()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._advance()


def _now(spark: SparkSession, memories: DataFrame, out_dir: str) -> tuple[DataFrame, DataFrame]:
    """(spaces with unfinished memories, vectors), as far as the stream has come. Statuses are read first, so
    the vectors of everything that counts as finished are there."""
    if not IX.has_batches(spark, out_dir):
        kinds = {f.name: f.dataType for f in memories.schema}
        vectors = T.StructType([
            T.StructField("chunk_id", T.StringType()), T.StructField("memory_id", kinds["memory_id"]), T.StructField("space_id", kinds["space_id"]),
            T.StructField("chunk_index", T.IntegerType()), T.StructField("chunk_text", T.StringType()),
            T.StructField("embedding", T.ArrayType(T.FloatType()))])
        return memories.select("space_id").distinct(), spark.createDataFrame([], vectors)
    status = IX.latest_status(spark, out_dir).where(~F.col("processing_status").isin(*IX.UNFINISHED))
    unfinished = memories.join(status.select("memory_id"), "memory_id", "left_anti")
    return materialized(unfinished.select("space_id").distinct()), IX.indexed_vectors(spark, out_dir)


def search_when_indexed(requests: DataFrame, memories: DataFrame, out_dir: str, search: Callable[[DataFrame, DataFrame], DataFrame], *,
                        max_wait_ms: int = S.MAX_WAIT_MS, poll_interval_ms: int = S.POLL_INTERVAL_MS,
                        wait: bool = S.DEFAULT_WAIT_FOR_INDEXING, streams: SparkSession | None = None) -> tuple[DataFrame, DataFrame]:
    """Answers ``requests`` (query_id, space_ids, what ``search`` needs) beside an indexing stream that writes to ``out_dir``.

    ``search(requests, vectors)`` gives result rows with ``query_id``. A request is answered by its first
    non-empty result. One without results is closed as soon as none of its spaces holds unfinished
    memories (``memories``: the submitted ones, memory_id and space_id); the others are searched again until
    ``max_wait_ms`` have passed. ``wait=False`` searches once. ``streams``: the session the stream runs in.

    Returns the result rows and, per request, ``total_results`` and ``message``; only requests that ran out
    of time have a message. There are at most max_wait / poll_interval + batches rounds."""
    spark = requests.sparkSession
    todo = asked = materialized(requests)
    spaces = materialized(restrict_to_spaces(asked))
    memories = memories.select("memory_id", "space_id")
    progress, results = Progress(), None
    manager = (streams or spark).streams
    manager.addListener(progress)
    try:
        end = time.monotonic() + (max_wait_ms / 1000 if wait else 0)
        while True:
            seen, last = progress.n, time.monotonic() >= end
            busy, vectors = _now(spark, memories, out_dir)
            found = materialized(search(todo, vectors))
            results = found if results is None else results.unionByName(found)
            waiting = spaces.join(busy, "space_id", "left_semi").select("query_id").distinct()
            todo = materialized(todo.join(found.select("query_id").distinct(), "query_id", "left_anti")
                                .join(waiting, "query_id", "left_semi"))
            if last or todo.isEmpty():
                break
            progress.wait(seen, min(poll_interval_ms / 1000, max(0.0, end - time.monotonic())))
    finally:
        manager.removeListener(progress)
    counts = results.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    late = todo.select("query_id").distinct().withColumn("late", F.lit(wait))
    totals = asked.select("query_id").join(counts, "query_id", "left").join(late, "query_id", "left").select(
        "query_id", F.coalesce("n", F.lit(0)).alias("total_results"), F.when(F.col("late"), S.MSG_STILL_PROCESSING).alias("message"))
    return results, totals
