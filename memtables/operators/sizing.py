"""Broadcast only behind a proven size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 1_000_000


def scan_bytes(df: DataFrame) -> int:
    """Bytes of the files ``df`` reads: the sum of Catalyst's size statistics
    of its leaf relations (no job runs). Join estimates are not used: without
    cost-based statistics they multiply the input sizes."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves().iterator()
    total = 0
    while leaves.hasNext():
        total += int(str(leaves.next().stats().sizeInBytes()))
    return total


SEMI_JOIN_REDUCTION_BYTES = 1 << 30   # big tables above this are cut by key first


def reduce_to_keys(big: DataFrame, small: DataFrame, key: str,
                   max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``big`` restricted to the keys present in ``small`` by a broadcast
    semi-join, when a bounded count proves the key set small and ``big``'s
    files are large enough to be worth it; otherwise ``big`` unchanged. The
    big table is then scanned but not shuffled to meet a small one.
    ``small`` should be cheap to read twice (a scan or a written table)."""
    if scan_bytes(big) <= SEMI_JOIN_REDUCTION_BYTES:
        return big
    keys = small.select(key).distinct()
    if keys.limit(max_rows + 1).count() > max_rows:
        return big
    return big.join(F.broadcast(keys), key, "left_semi")


def spread(df: DataFrame) -> DataFrame:
    """Before CPU-heavy per-row work: when ``df`` has fewer partitions than
    the cluster has cores (a small input, e.g. one Parquet row group), spread
    its rows round-robin over the cores; otherwise leave it alone (a large
    input is already split by the scan, and a shuffle would be waste). The size comes
    from the scanned files' statistics: no job runs. Spark splits a scan into at least
    one part per core once there are ``openCostInBytes`` for each."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if scan_bytes(df) >= cores * (4 << 20):
        return df
    return df.repartition(cores)
