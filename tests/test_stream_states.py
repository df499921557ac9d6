"""The indexing stream's keyed states (failed, sent again, retried) and searching beside it with a deadline."""

import datetime
import os
import tempfile
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from memtables import schema as S
from memtables.operators import embedding as EM
from memtables.operators import retrieval as R
from memtables.streaming import indexing as IX
from memtables.streaming import waiting as W

ROW = "memory_id long, space_id string, original_content string, created_at timestamp, labels map<string,string>"


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="memtables-states-")


class Feed:
    """Memories arriving as files; one run of the stream per arrival, all on one checkpoint."""

    def __init__(self, spark, root, **kw):
        self.spark, self.root, self.n, self.kw = spark, root, 0, kw

    def stream(self):
        return self.spark.readStream.schema(ROW).parquet(f"{self.root}/in/n=*")

    def send(self, *rows):
        rows = [(*r, datetime.datetime(2024, 1, 1), {"a": "b"}) for r in rows]
        self.spark.createDataFrame(rows, ROW).coalesce(1).write.parquet(f"{self.root}/in/n={self.n}")
        self.n += 1

    def run(self):
        IX.drain(IX.stream_index_memories(self.stream(), f"{self.root}/out", f"{self.root}/ck", chunker=IX.fixed_chunker, **self.kw))

    def states(self):
        return {r.memory_id: (r.processing_status, r.attempt, r.error) for r in IX.latest_status(self.spark, f"{self.root}/out").collect()}

    def texts(self):
        return sorted((r.memory_id, r.chunk_text) for r in IX.indexed_vectors(self.spark, f"{self.root}/out").collect())


def test_failed_memory_is_tried_again(spark, root):
    feed = Feed(spark, root)
    feed.send((1, "s", None), (2, "s", "two"), (3, "s", ""), (None, "s", "no id"), (4, "s", ""), (4, "s", "four"))
    feed.run()
    assert feed.states() == {1: ("FAILED", 1, S.MSG_NO_TEXT), 2: ("COMPLETED", 1, None), 3: ("FAILED", 1, S.MSG_NO_TEXT),
                             4: ("COMPLETED", 1, None), None: ("FAILED", 1, S.MSG_NO_MEMORY_ID)}
    feed.send((1, "s", "one"), (2, "s", "another two"), (3, "s", None), (2, "s", None))
    feed.run()
    assert feed.states()[1] == ("COMPLETED", 2, None) and feed.states()[2] == ("COMPLETED", 1, None)
    assert feed.states()[3] == ("FAILED", 2, S.MSG_NO_TEXT)
    assert feed.texts() == [(1, "one"), (2, "two"), (4, "four")]
    # every memory went through PROCESSING before it was completed
    phases = spark.read.parquet(f"{root}/out/status").where("phase = 0").collect()
    assert sorted(r.memory_id for r in phases) == [1, 2, 4] and {r.processing_status for r in phases} == {"PROCESSING"}
    feed.run()                                              # nothing new: nothing changes
    assert feed.texts() == [(1, "one"), (2, "two"), (4, "four")]


def test_memories_the_embedder_fails_on_are_retried(spark, root):
    marker = os.path.join(root, "mended")

    @F.pandas_udf("array<float>")
    def picky(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if "bad" in t and not os.path.exists(marker) else [1.0, float(len(t))])
    EM.register_embedder("picky", picky, 2)
    try:
        feed = Feed(spark, root, embedder_id="picky", max_attempts=2)
        feed.send((1, "s", "good"), (2, "s", "bad" + "x" * 600 + "bad"))
        feed.run()
        assert feed.states() == {1: ("COMPLETED", 1, None), 2: ("FAILED", 1, S.MSG_NOT_EMBEDDED)}
        assert feed.texts() == [(1, "good")]                # no part of a failed memory is seen
        feed.run()                                          # tried again, in vain
        assert feed.states()[2] == ("FAILED", 2, S.MSG_NOT_EMBEDDED)
        feed.run()                                          # attempts used up: waits to be sent again
        assert feed.states()[2] == ("FAILED", 2, S.MSG_NOT_EMBEDDED)
        open(marker, "w").close()
        feed.run()
        assert feed.states()[2] == ("FAILED", 2, S.MSG_NOT_EMBEDDED)
        feed.send((2, "s", "bad no more"), (1, "s", "good again"))
        feed.run()
        assert feed.states() == {1: ("COMPLETED", 1, None), 2: ("COMPLETED", 3, None)}
        assert feed.texts() == [(1, "good"), (2, "bad no more")]
    finally:
        EM._CUSTOM.pop("picky")


def _slow(spark, root, seconds, **wait):
    """Requests over two spaces while a stream indexes them with an embedder that takes ``seconds``; a third
    space holds nothing."""
    @F.pandas_udf("array<float>")
    def slow(texts: pd.Series) -> pd.Series:
        time.sleep(seconds if len(texts) else 0)
        return texts.map(lambda t: [1.0, float(len(t))])
    EM.register_embedder("slow", slow, 2)
    feed = Feed(spark, root)
    feed.send((1, "a", "one"), (2, "b", "two"))
    requests = spark.createDataFrame([(1, [1.0, 3.0], "a"), (2, [1.0, 3.0], "b"), (3, [1.0, 3.0], "none"), (4, [1.0, 3.0], "a,none")],
                                     "query_id long, query_vector array<float>, space_ids string")
    memories = spark.createDataFrame([(1, "a"), (2, "b")], "memory_id long, space_id string")
    query = IX.stream_index_memories(feed.stream(), f"{root}/out", f"{root}/ck", chunker=IX.fixed_chunker, embedder_id="slow")
    try:
        start = time.monotonic()
        results, totals = W.search_when_indexed(requests, memories, f"{root}/out", R.retrieve_topk, **wait)
        took = time.monotonic() - start
        return [r.query_id for r in results.orderBy("query_id").collect()], {r.query_id: (r.total_results, r.message) for r in totals.collect()}, took
    finally:
        IX.drain(query)
        EM._CUSTOM.pop("slow")


def test_search_returns_when_its_spaces_are_indexed(spark, root):
    found, totals, _ = _slow(spark, root, 2, max_wait_ms=120_000, poll_interval_ms=60_000)
    assert found == [1, 2, 4]
    assert totals == {1: (1, None), 2: (1, None), 3: (0, None), 4: (1, None)}


def test_search_says_when_time_ran_out(spark, root):
    found, totals, _ = _slow(spark, root, 25, max_wait_ms=1_000, poll_interval_ms=500)
    assert found == []
    assert totals == {1: (0, S.MSG_STILL_PROCESSING), 2: (0, S.MSG_STILL_PROCESSING), 3: (0, None), 4: (0, S.MSG_STILL_PROCESSING)}


def test_search_without_waiting_has_no_message(spark, root):
    memories = spark.createDataFrame([(1, "a")], "memory_id long, space_id string")
    requests = spark.createDataFrame([(1, [1.0], "a")], "query_id long, query_vector array<float>, space_ids string")
    results, totals = W.search_when_indexed(requests, memories, f"{root}/out", R.retrieve_topk, wait=False)
    assert results.count() == 0 and [tuple(r) for r in totals.collect()] == [(1, 0, None)]
