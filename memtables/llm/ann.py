"""Nearest neighbours by a permutation index.

Every vector is represented by its ``prefix`` nearest pivots, in order. Pivots
are ``n_pivots`` vectors of a bounded deterministic sample. Each block of rows
(about ``BLOCK_ROWS``, by hash of the id) posts its permutations in pivot
inverted files: for each pivot, the rows that hold it and its place in them. A
query reads the lists of its own pivots and adds up, for each row met, the
footrule distance between the two prefixes (a pivot that one of them lacks
stands at place ``prefix``). The share ``candidates`` of the block's vectors (at least ``4 k``) that has the
least footrule distance is reranked by exact Euclidean distance in double precision, in blocks of any size. Equal
vectors of a block count as one, which answers with its smallest ids, so a group of
copies doesn't crowd out other candidates. The block's best k go on, and one
window per query keeps the k nearest of all blocks.

Every row is indexed and every block answers every query, so the candidates of a
query grow with the data and the recall stays (measured against brute force
in the tests and README). The queries and their permutations are computed once and written to the shared folder in
files of about ``QUERY_BYTES``; a task reads one file after another against its block. No query passes
through the driver, and the vectors are never shuffled against the queries.

Defined results: null or zero vectors and those with null or non-finite
components take no part, nor do rows with a null id; vectors of unequal lengths
are not compared; rows that share the query's id are its own; an id in several
rows answers once, with its nearest row, and asks once, with its least vector; fewer rows than k: all
of them; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from memtables.llm.common import bounded_sample
from memtables.operators.retrieval import open_parquet
from memtables.session import materialized

K = 10
N_PIVOTS = 256
PREFIX = 128
CANDIDATES = 0.25
BLOCK_ROWS = 8192
QUERY_BYTES = 32 << 20


def usable(v: Column) -> Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)


class Block:
    """The inverted files of one block of rows of equal length, sorted by id."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, pivots: np.ndarray, prefix: int):
        self.x, of = np.unique(x, axis=0, return_inverse=True)
        order = np.lexsort((ids, of.ravel()))
        self.ids, of = ids[order], of.ravel()[order]
        self.first = np.searchsorted(of, np.arange(len(self.x) + 1))
        self.prefix = min(prefix, len(pivots))
        flat = permutations(self.x, pivots, self.prefix).ravel()
        by_pivot = np.argsort(flat, kind="stable")
        self.row, self.place = by_pivot // self.prefix, by_pivot % self.prefix
        self.at = np.searchsorted(flat[by_pivot], np.arange(len(pivots) + 1))

    def nearest(self, query_id: int, q: np.ndarray, perm: np.ndarray, k: int, candidates: float) -> tuple[np.ndarray, np.ndarray]:
        far = np.full(len(self.x), self.prefix * (self.prefix + 1), np.int64)
        for j, p in enumerate(perm.tolist()):
            rows, place = self.row[self.at[p]:self.at[p + 1]], self.place[self.at[p]:self.at[p + 1]]
            far[rows] += np.abs(place - j) - (self.prefix - place) - (self.prefix - j)
        keep, n = np.arange(len(far)), max(4 * k, math.ceil(candidates * len(far)))
        if len(far) > n:
            keep = np.argpartition(far * len(far) + keep, n)[:n]
        gap = np.sqrt(((self.x[keep] - q) ** 2).sum(axis=1))
        # the k + 1 nearest vectors hold the k nearest rows besides the query's own
        near = np.argsort(gap, kind="stable")
        if len(near) > k + 1:
            near = near[gap[near] <= gap[near[k]]]
        ids, gaps = [], []
        for i in near.tolist():
            own = self.ids[self.first[keep[i]]:self.first[keep[i] + 1]]
            own = np.unique(own[own != query_id])[:k]
            ids.append(own)
            gaps.append(np.full(len(own), gap[i]))
        ids, gaps = np.concatenate(ids), np.concatenate(gaps)
        order = np.lexsort((ids, gaps))
        ids, gaps = ids[order], gaps[order]
        first = np.sort(np.unique(ids, return_index=True)[1])[:k]
        return ids[first], gaps[first]


def permutations(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The numbers of each row's nearest pivots, nearest first (ties: smaller number)."""
    out = np.empty((len(x), prefix), np.int64)
    size = (pivots * pivots).sum(axis=1)
    for at in range(0, len(x), 4096):
        gap = size - 2 * (x[at:at + 4096] @ pivots.T)
        out[at:at + 4096] = np.argsort(gap, axis=1, kind="stable")[:, :prefix]
    return out


def search(vectors: DataFrame, queries: DataFrame, *, id_col: str = "vec_id", vector: str = "embedding", k: int = K,
           n_pivots: int = N_PIVOTS, prefix: int = PREFIX, candidates: float = CANDIDATES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` of the k nearest rows found for
    each row of ``queries`` (columns like ``vectors``)."""
    def clean(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("x")).where(
            F.col("id").isNotNull() & usable(F.col("x")))
    rows = clean(vectors)
    asked = clean(queries).groupBy("id").agg(F.min("x").alias("x"))
    sizes = {r["d"]: r["n"] for r in rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).collect()}
    # pivots for each vector length: distinct vectors of a sample of 4 * n_pivots rows
    pivots = {}
    for d in sizes:
        got = bounded_sample(rows.where(F.size("x") == d), 4 * n_pivots, "id", total=sizes[d]).collect()
        one = np.unique(np.array([r["x"] for r in got], np.float64), axis=0)
        pivots[d] = one[np.random.default_rng(1).permutation(len(one))[:n_pivots]]
    n = sum(sizes.values())
    blocks = max(1, -(-n // block_rows))
    asked = materialized(_with_permutations(asked, pivots, prefix))
    size = asked.agg(F.sum(8 * F.size("x") + 4 * F.size("perm"))).first()[0] or 0
    asked = materialized(asked.repartition(max(1, -(-size // QUERY_BYTES)), "id"))
    best = _candidates(rows.repartition(blocks, "id"), asked.inputFiles() if size else [], pivots, k, prefix, candidates)
    nearest = best.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    line = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (nearest.withColumn("rank", F.row_number().over(line)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def _rows(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, all components one after another, and the vectors' lengths."""
    x = batch.column("x")
    x = x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
    return batch.column("id").to_numpy(), x.flatten().to_numpy(), x.value_lengths().to_numpy(zero_copy_only=False)


def _of_length(flat: np.ndarray, size: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and matrix of the vectors of length ``d``."""
    mine = np.flatnonzero(size == d)
    return mine, flat[(np.cumsum(size)[mine] - d)[:, None] + np.arange(d)]


def _with_permutations(asked: DataFrame, pivots: dict[int, np.ndarray], prefix: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, flat, size = _rows(batch)
            perm = np.empty(len(size), object)
            for d in np.unique(size).tolist():
                mine, x = _of_length(flat, size, d)
                if d in pivots:
                    for i, p in zip(mine.tolist(), permutations(x, pivots[d], min(prefix, len(pivots[d])))):
                        perm[i] = p.astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("x"), pa.array(perm.tolist(), pa.list_(pa.int32()))], names=["id", "x", "perm"])
    return asked.mapInArrow(run, "id long, x array<double>, perm array<int>").where("perm is not null")


def _candidates(rows: DataFrame, files: list[str], pivots: dict[int, np.ndarray], k: int, prefix: int, candidates: float) -> DataFrame:
    """The k nearest candidates of each query in each block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_rows(b) for b in batches]
        if not parts:
            return
        ids, flat, size = (np.concatenate(c) for c in zip(*parts))
        blocks = {}
        for d in np.unique(size).tolist():
            mine, x = _of_length(flat, size, d)
            blocks[d] = Block(ids[mine], x, pivots[d], prefix)
        for f in files:
            table = open_parquet(f).read()
            query_ids, q_flat, q_size = _rows(table)
            perms = table.column("perm").combine_chunks()
            for d, block in blocks.items():
                mine, x = _of_length(q_flat, q_size, d)
                if not len(mine):
                    continue
                perm = perms.take(pa.array(mine)).flatten().to_numpy().reshape(len(mine), -1)
                asked = query_ids[mine]
                out = [block.nearest(i, q, p, k, candidates) for i, q, p in zip(asked.tolist(), x, perm)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(asked, [len(o[0]) for o in out])), pa.array(np.concatenate([o[0] for o in out])),
                     pa.array(np.concatenate([o[1] for o in out]))], names=["query_id", "vec_id", "score"])
    return rows.mapInArrow(run, "query_id long, vec_id long, score double")
