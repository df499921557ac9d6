"""Embedding (43): chunk text -> vector, by embedder id.

Embedders are pluggable by id. Built in:

* ``hash-256`` (stand-in model): hashed bag of words, L2-normalised. Words
  and their MD5 buckets are built-in SQL; counting and normalising run as
  numpy over Arrow batches (a ``pandas_udf``);
* ``emb-64``: the same with 64 buckets (the data's own vectors have this size).

A real model plugs in with :func:`register_embedder` as a pandas UDF
(Arrow batches, one model load per Python worker).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from memtables.operators.outcomes import with_outcome
from memtables.operators.sizing import spread

HASH_DIM = 256
_COUNT_ROWS = 1_024               # vectors counted at once inside one task

# id, name, dimension of the built-in embedders
BUILTIN = [("emb-64", "precomputed 64-d vectors", 64),
           ("hash-256", "hashed bag of words", HASH_DIM)]

_CUSTOM: dict[str, tuple[Callable, int]] = {}


def register_embedder(embedder_id: str, fn: Callable, dim: int) -> None:
    """``fn``: a pandas UDF (or Column function) text -> array<float>."""
    _CUSTOM[embedder_id] = (fn, dim)


def embedder_registry(spark: SparkSession) -> DataFrame:
    rows = BUILTIN + [(k, k, d) for k, (_, d) in _CUSTOM.items()]
    schema = T.StructType([T.StructField("embedder_id", T.StringType(), False),
                           T.StructField("name", T.StringType()),
                           T.StructField("dim", T.IntegerType())])
    return spark.createDataFrame(rows, schema)


def word_terms(text_col: str) -> F.Column:
    parts = F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda x: x != "")


def term_buckets(text_col: str, dim: int | F.Column = HASH_DIM) -> F.Column:
    """Bucket of every word: the first 32 bits of its MD5, modulo ``dim``
    (built-in SQL; the same rule is expressible in any SQL engine)."""
    return F.transform(word_terms(text_col), lambda t: F.pmod(
        F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("long"), F.lit(dim) if isinstance(dim, int) else dim).cast("int"))


def _unit_counts_udf():
    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def unit_counts(buckets: pd.Series, dims: pd.Series) -> pd.Series:
        """Bucket ids -> L2-normalised counts of the row's dimension (null: no vector),
        one Arrow batch at a time."""
        dims = dims.fillna(0).to_numpy().astype(np.int64)
        dim = int(dims.max(initial=1))
        buckets = buckets.where(dims > 0, pd.Series([[]] * len(buckets), index=buckets.index))
        out = np.empty((len(buckets), dim), dtype=np.float32)
        for i in range(0, len(buckets), _COUNT_ROWS):
            some = buckets.iloc[i:i + _COUNT_ROWS].to_list()
            lens = np.array([len(b) for b in some])
            flat = np.concatenate(some).astype(np.int64) if lens.sum() else np.zeros(0, np.int64)
            at = np.repeat(np.arange(len(some)) * dim, lens) + flat
            counts = np.bincount(at, minlength=len(some) * dim).reshape(len(some), dim).astype(np.float64)
            norms = np.sqrt((counts * counts).sum(axis=1))
            nz = norms > 0
            counts[nz] /= norms[nz, None]
            out[i:i + len(some)] = counts
        return pd.Series([row[:d] if d else None for row, d in zip(out, dims.tolist())])
    return unit_counts


def hash_embed(df: DataFrame, text_col: str = "chunk_text", out_col: str = "embedding",
               dim: int = HASH_DIM) -> DataFrame:
    """Hashed bag of words, L2-normalised, as ``array<float>`` (all zeros for
    text without words): word buckets in SQL, counting in numpy."""
    return spread(df).withColumn(out_col, _unit_counts_udf()(term_buckets(text_col, dim), F.lit(dim)))


def embed_chunks(chunks: DataFrame, embedder_id: str = "hash-256", text_col: str = "chunk_text",
                 out_col: str = "embedding") -> DataFrame:
    for name, _, dim in BUILTIN:
        if embedder_id == name:
            return hash_embed(chunks, text_col, out_col, dim)
    if embedder_id in _CUSTOM:
        fn, _ = _CUSTOM[embedder_id]
        return chunks.withColumn(out_col, fn(F.col(text_col)))
    raise ValueError(f"unknown embedder {embedder_id!r}")


def embed_by_space(chunks: DataFrame, spaces: DataFrame, default: str = "hash-256", text_col: str = "chunk_text",
                   out_col: str = "embedding") -> DataFrame:
    """Every chunk embedded by the first embedder of its space (no space, or a space
    without embedders: ``default``). Adds ``embedder_id``, the vector and the outcome; an unknown
    embedder gives a null vector and an error."""
    per = spaces.select("space_id", F.get(F.col("space_embedders")["embedder_id"], F.lit(0)).alias("embedder_id"))
    j = chunks.join(per, "space_id", "left").withColumn("embedder_id", F.coalesce("embedder_id", F.lit(default)))
    which = F.col("embedder_id")
    dim = F.try_element_at(F.create_map(*(F.lit(x) for name, _, d in BUILTIN for x in (name, d))), which)
    j = spread(j).withColumn(out_col, _unit_counts_udf()(term_buckets(text_col, dim), dim))
    for name, (fn, _) in _CUSTOM.items():
        # rows of other embedders pass null, so the model has nothing to do for them
        j = j.withColumn(out_col, F.when(which == name, fn(F.when(which == name, F.col(text_col)))).otherwise(F.col(out_col)))
    known = which.isin(*(name for name, _, _ in BUILTIN), *_CUSTOM)
    return with_outcome(j, F.when(~known, F.concat(F.lit("Unknown embedder: "), which)))


def embed_queries(requests: DataFrame, embedder_id: str = "hash-256") -> DataFrame:
    """Text requests -> requests with ``query_vector``: the query text embedded
    with the same embedder as the searched chunks (the reference's retrieve
    takes text and leaves the embedding to the server)."""
    return embed_chunks(requests, embedder_id, text_col="query_text", out_col="query_vector")
