"""Registry of end-to-end queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        return fn
    return deco


def all_queries() -> dict[str, QueryFn]:
    # importing the modules registers their queries
    from memtables.plans import q_retrieval, q_catalog, q_ingest, q_parse, q_chunking  # noqa: F401
    from memtables.plans import q_streaming  # noqa: F401
    return dict(_QUERIES)
