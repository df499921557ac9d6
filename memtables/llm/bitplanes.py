"""Clustering around centroids with exact integer distances from bit planes.

A component x becomes the integer floor(scale * x). Plane b of a vector of 64 components is one unsigned
64-bit number: bit i is bit b of component i in two's complement, so plane b weighs 2^b and
the last one -2^b. The dot product of a vector and a centroid is the sum over all pairs of their planes
of weight times weight times popcount(plane AND plane), and the squared distance is
|x|^2 - 2 x.c + |c|^2. Everything is exact.

The planes of all vectors are written once; a round reads them, never the vectors. A round assigns
every vector to the nearest centroid (ties: the smaller number) and adds up each cluster's
components inside the tasks; what reaches the driver is at most k x 64 sums, whatever the data.
An empty cluster keeps its centroid.

Which rows take part: vectors with exactly 64 components, none null or non-finite, whose integers fit
28 bits (|scale * x| < 2^27, as far as the sums of squares fit a long); others are left out.
The first k rows by the given key give the first centroids; fewer rows, fewer centroids. Equal keys (repeated
ids) are taken in order of the vectors. Repeated rows are rows each. A null id takes part and has the last
key. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from memtables.session import materialized

WIDTH = 64
SCALE = 256
#: Integers are below 2^MAX_BITS, so 64 squared differences fit a long.
MAX_BITS = 27
ROUNDS = 5
K = 40
#: Vectors that one numpy step compares with all centroids.
STEP = 1024


# -- planes ----------------------------------------------------------------------

def planes(numbers: np.ndarray) -> np.ndarray:
    """The bit planes (n x planes, unsigned 64 bit) of integer vectors (n x 64), as many as the numbers need."""
    most = int(np.maximum(numbers, ~numbers).max(initial=0))
    n_planes = most.bit_length() + 1
    out = np.empty((len(numbers), n_planes), np.uint64)
    for b in range(n_planes):
        bits = ((numbers >> b) & 1).astype(np.uint8)
        out[:, b] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def weights(n_planes: int) -> list[int]:
    return [*(1 << b for b in range(n_planes - 1)), -1 << (n_planes - 1)]


def dots(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact dot products (n x k) of vectors and centroids given as planes."""
    n, k = len(x), len(c)
    out = np.zeros((n, k), np.int64)
    meet, ones = np.empty((n, k), np.uint64), np.empty((n, k), np.uint8)
    x_last, c_last = x.shape[1] - 1, c.shape[1] - 1
    for s in range(x_last + c_last + 1):
        # all pairs of planes of weight 2^s, at most 28 x 64 ones
        part = np.zeros((n, k), np.int16)
        for b in range(max(0, s - c_last), min(s, x_last) + 1):
            np.bitwise_and(x[:, b, None], c[None, :, s - b], out=meet)
            np.bitwise_count(meet, out=ones)
            if (b == x_last) != (s - b == c_last):
                np.subtract(part, ones, out=part, casting="unsafe")
            else:
                np.add(part, ones, out=part, casting="unsafe")
        out += part.astype(np.int64) << s
    return out


def squares(x: np.ndarray) -> np.ndarray:
    """Squared lengths of vectors given as planes."""
    w = weights(x.shape[1])
    out = np.zeros(len(x), np.int64)
    for a in range(len(w)):
        for b in range(a, len(w)):
            out += np.bitwise_count(x[:, a] & x[:, b]).astype(np.int64) * (w[a] * w[b] * (1 + (a != b)))
    return out


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of and squared distance to the nearest centroid (k x 64 integers) of each vector (planes)."""
    c = planes(centroids)
    length = squares(c)
    cluster, distance = np.empty(len(x), np.int32), np.empty(len(x), np.int64)
    for a in range(0, len(x), STEP):
        part = x[a:a + STEP]
        d = squares(part)[:, None] - 2 * dots(part, c) + length
        best = d.argmin(axis=1)
        cluster[a:a + STEP] = best
        distance[a:a + STEP] = d[np.arange(len(part)), best]
    return cluster, distance


def component_sums(x: np.ndarray, cluster: np.ndarray, k: int) -> np.ndarray:
    """Sums of the components (k x 64) by cluster, from planes: ones of each bit, weighted."""
    out = np.zeros((k, WIDTH), np.int64)
    order = np.argsort(cluster, kind="stable")
    seen, first = np.unique(cluster[order], return_index=True)
    for b, w in enumerate(weights(x.shape[1])):
        bits = np.unpackbits(np.ascontiguousarray(x[order, b]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        out[seen] += np.add.reduceat(bits, first, axis=0, dtype=np.int64) * w
    return out


def _read(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, planes) of a binary column; rows with equally many planes come together."""
    rows = column.to_pylist()
    width = np.fromiter(map(len, rows), np.int64, len(rows))
    for n in np.unique(width).tolist():
        at = np.flatnonzero(width == n)
        yield at, np.frombuffer(b"".join([rows[i] for i in at.tolist()]), "<u8").reshape(-1, n // 8)


# -- operator ----------------------------------------------------------------------

def takes_part(vector: Column, scale: int = SCALE) -> Column:
    limit = F.lit(float(1 << MAX_BITS))
    inside = F.forall(vector, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v.cast("double") * scale) < limit), F.lit(False)))
    return F.coalesce((F.size(vector) == WIDTH) & inside, F.lit(False))


def packed(vectors: DataFrame, *, id_col: str, vector: str, scale: int = SCALE) -> DataFrame:
    """``id_col`` and ``planes`` (binary, little-endian unsigned 64 bit) of the vectors that take part."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            flat = batch.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            x = planes(np.floor(flat * scale).astype(np.int64).reshape(-1, WIDTH))
            data, step = x.astype("<u8").tobytes(), 8 * x.shape[1]
            yield pa.array([data[i:i + step] for i in range(0, len(data), step)], pa.binary())
    kept = vectors.where(takes_part(F.col(vector), scale))
    return kept.select(id_col, F.arrow_udf(run, "binary")(F.col(vector).cast("array<double>")).alias("planes"))


def first_centroids(vectors: DataFrame, key: Column, *, vector: str, k: int = K, scale: int = SCALE) -> np.ndarray:
    """The integers of the first ``k`` rows by ``key``; null keys last."""
    kept = vectors.where(takes_part(F.col(vector), scale)).select(key.alias("key"), F.col(vector).cast("array<double>").alias("v"))
    rows = kept.orderBy(F.col("key").asc_nulls_last(), "v").limit(k).collect()
    return np.array([np.floor(np.array(r["v"]) * scale) for r in rows], np.float64).astype(np.int64).reshape(-1, WIDTH)


def assign(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``rows`` with ``cluster`` and ``distance`` in place of ``planes``."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            cluster, distance = np.empty(len(batch), np.int32), np.empty(len(batch), np.int64)
            for at, x in _read(batch):
                cluster[at], distance[at] = nearest(x, centroids)
            yield pa.StructArray.from_arrays([pa.array(cluster), pa.array(distance)], names=["cluster", "distance"])
    return rows.withColumn("planes", F.arrow_udf(run, "struct<cluster: int, distance: bigint>")("planes")).select(
        *(c for c in rows.columns if c != "planes"), "planes.cluster", "planes.distance")


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: the exact floor of each non-empty cluster's mean."""
    k = len(centroids)
    schema = T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("n", T.LongType()),
                           T.StructField("sums", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, np.int64), np.zeros((k, WIDTH), np.int64)
        for batch in batches:
            for _, x in _read(batch.column("planes")):
                cluster, _ = nearest(x, centroids)
                n += np.bincount(cluster, minlength=k)
                sums += component_sums(x, cluster, k)
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([
            pa.array(seen.astype(np.int32)), pa.array(n[seen]),
            pa.array(sums[seen].tolist(), pa.list_(pa.int64()))], names=schema.names)
    total = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(WIDTH)]
    out = centroids.copy()
    for r in rows.select("planes").mapInArrow(run, schema).groupBy("cluster").agg(F.sum("n").alias("n"), *total).collect():
        out[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(WIDTH)]
    return out


def cluster(vectors: DataFrame, key: Column, *, id_col: str = "vec_id", vector: str = "embedding", k: int = K,
            rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """``id_col``, ``cluster``, ``distance`` (squared), ``cluster_inertia`` and ``inertia`` (distances summed over
    the cluster and over all) and ``centroid`` (array of 64 longs) of each vector that takes part."""
    centroids = first_centroids(vectors, key, vector=vector, k=k, scale=scale)
    rows = materialized(packed(vectors, id_col=id_col, vector=vector, scale=scale))
    if len(centroids):
        for _ in range(rounds):
            centroids = moved(rows, centroids)
    found = materialized(assign(rows, centroids))
    # at most k rows
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    of = found.sparkSession.createDataFrame(
        [(c, s, sum(sums.values()), centroids[c].tolist()) for c, s in sums.items()],
        "of int, cluster_inertia long, inertia long, centroid array<long>")
    return found.join(F.broadcast(of), found["cluster"] == of["of"]).drop(of["of"])


def digest(centroid: Column) -> Column:
    """SHA-256 of the components as decimal integers joined by commas."""
    return F.sha2(F.encode(F.array_join(centroid.cast("array<string>"), ","), "UTF-8"), 256)


def seed_key(name: Column, salt: str = "2") -> Column:
    """Order in which rows become first centroids: SHA-256 of ``salt:name``."""
    return F.sha2(F.encode(F.concat(F.lit(f"{salt}:"), name.cast("string")), "UTF-8"), 256)
