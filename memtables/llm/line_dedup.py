"""Incremental, reversible line dedup: sharded cuckoo filters backed by exact
reference-count tables.

A line's key is the line with ASCII white space stripped at both ends and A-Z
lower-cased (kept as its 128-bit hash). Keys of at least ``min_chars`` code
points found in at least ``min_docs`` documents lose all their lines except in
the largest document id holding them.

State (:class:`LineState`), three tables in the session's shared folder:

* ``postings``: each (key, document) once; the exact reference table;
* ``refs``: shard, key, ``n_docs`` (reference count) and ``keeper`` (largest id);
* ``filters``: one cuckoo filter per shard, holding the keys whose count has
  reached ``min_docs``. A key enters its shard's filter when its count
  reaches the bound and leaves it when deletions take the count below; the exact
  counts decide, so a delete never removes another key's entry.

:func:`insert` and :func:`delete` return a new state; deleting what was
inserted gives back the earlier decisions. :func:`drop_lines` probes each line
of each text in its shard's filter. Only hits go on to the exact table, which
decides; the filter never decides alone. Filters go to the tasks by broadcast
while their total size (checked) is at most ``FILTER_BYTES``; beyond that the keys go to
their shard's filter, in pieces of about ``PIECE`` keys, with the same result.

Shards hold about ``SHARD_KEYS`` repeated keys; with more keys a state is re-cut
into more shards. A key that many documents share is counted by partial sums.

Defined results: null and empty texts are one empty line; a document id that
occurs in several rows counts as one document, and each of its rows is treated
alike; rows with a null id are not counted and keep their lines; an empty table
gives no rows; extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from memtables.llm.common import fresh, utf8
from memtables.session import materialized

MIN_CHARS = 40
MIN_DOCS = 5
SHARD_KEYS = 200_000
FILTER_BYTES = 64 << 20
PIECE = 500_000


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The 16-byte key of a raw line, None if it is too short."""
    line = line.strip()
    if len(line) < min_chars:
        return None
    # code points: bytes that don't continue one
    if len(line) < 4 * min_chars and not line.isascii() and len(line.decode("utf-8", "replace")) < min_chars:
        return None
    from xxhash import xxh3_128_digest
    return xxh3_128_digest(line.lower())


# -- cuckoo filter ---------------------------------------------------------------

class CuckooFilter:
    """Approximate set of 16-byte keys with deletion: 16-bit fingerprints, four to a
    bucket, two buckets to a key. Grows (by the caller's exact keys) when full."""
    SLOTS, KICKS = 4, 400

    def __init__(self, n_keys: int = 0, table: np.ndarray | None = None):
        if table is None:
            buckets = 1 << max(2, int(np.ceil(np.log2(max(1, n_keys) / (0.85 * self.SLOTS)))))
            table = np.zeros((buckets, self.SLOTS), np.uint16)
        self.table = table

    @staticmethod
    def _hashes(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprints, first buckets before the mask); ``keys``: (n, 2) uint64."""
        fp = (keys[:, 1] >> np.uint64(48)).astype(np.uint16)
        return np.where(fp == 0, np.uint16(1), fp), keys[:, 1] & np.uint64((1 << 40) - 1)

    @staticmethod
    def _other(fp):
        """What takes a fingerprint's one bucket to its other one."""
        return np.asarray(fp).astype(np.uint64) * np.uint64(0x5BD1E995) >> np.uint64(3)

    def _places(self, keys):
        fp, h = self._hashes(keys)
        mask = np.uint64(len(self.table) - 1)
        first = h & mask
        return fp, first.astype(np.int64), ((first ^ self._other(fp)) & mask).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(0, bool)
        fp, a, b = self._places(keys)
        return (self.table[a] == fp[:, None]).any(axis=1) | (self.table[b] == fp[:, None]).any(axis=1)

    def insert(self, keys: np.ndarray) -> bool:
        """False if the table is too full; then build a larger one."""
        rng = np.random.default_rng(1)
        mask = len(self.table) - 1
        for fp, a, b in zip(*self._places(keys)):
            for at in (a, b):
                free = np.flatnonzero(self.table[at] == 0)
                if len(free):
                    self.table[at, free[0]] = fp
                    break
            else:
                for _ in range(self.KICKS):
                    slot = rng.integers(self.SLOTS)
                    fp, self.table[at, slot] = self.table[at, slot], fp
                    at = (at ^ int(self._other(fp))) & mask
                    free = np.flatnonzero(self.table[at] == 0)
                    if len(free):
                        self.table[at, free[0]] = fp
                        break
                else:
                    return False
        return True

    def delete(self, keys: np.ndarray) -> None:
        for fp, a, b in zip(*self._places(keys)):
            for at in (a, b):
                held = np.flatnonzero(self.table[at] == fp)
                if len(held):
                    self.table[at, held[0]] = 0
                    break

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        size = max(16, len(keys))
        while not (f := cls(size)).insert(keys):
            size *= 2
        return f


def _as_array(keys) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(k) for k in keys), ">u8").reshape(-1, 2).astype(np.uint64)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (keys[:, 0] % np.uint64(shards)).astype(np.int64)


# -- state -----------------------------------------------------------------------

@dataclass
class LineState:
    postings: DataFrame
    refs: DataFrame
    filters: DataFrame
    shards: int
    min_chars: int = MIN_CHARS
    min_docs: int = MIN_DOCS


def line_keys(docs: DataFrame, min_chars: int, *, id_col: str = "doc_id", text: str = "text",
              filters: dict[int, CuckooFilter] | None = None, shards: int = 1) -> DataFrame:
    """``doc`` and ``key`` of every distinct long line of every row; with ``filters`` only
    those that their shard's filter may hold."""
    schema = T.StructType([T.StructField("doc", T.LongType()), T.StructField("key", T.BinaryType())])
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(filters) if filters is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs_, keys = [], []
            for doc, data in zip(b.column("doc").to_pylist(), utf8(b.column("text"))):
                if len(data) < min_chars:
                    continue
                own = {k for line in data.split(b"\n") if (k := line_key(line, min_chars))}
                docs_ += [doc] * len(own)
                keys += own
            if sent is not None and keys:
                array = _as_array(keys)
                hit, shard = np.zeros(len(keys), bool), shard_of(array, shards)
                for s in np.unique(shard).tolist():
                    if s in sent.value:
                        hit[shard == s] = sent.value[s].contains(array[shard == s])
                docs_, keys = [d for d, h in zip(docs_, hit) if h], [k for k, h in zip(keys, hit) if h]
            yield pa.RecordBatch.from_arrays([pa.array(docs_, pa.int64()), pa.array(keys, pa.binary())], names=["doc", "key"])
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), F.col(text).alias("text"))
    return rows.mapInArrow(run, schema)


def _counts(postings: DataFrame) -> DataFrame:
    return postings.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc").alias("keeper"))


def _sharded(refs: DataFrame, shards: int) -> DataFrame:
    """``shard``: the first 8 bytes of the key, unsigned, modulo the number of shards."""
    high = F.conv(F.hex(F.substring("key", 1, 8)), 16, 10).cast("decimal(20,0)")
    return refs.withColumn("shard", (high % F.lit(shards)).cast("int"))


def _filters(changes: DataFrame, old: DataFrame | None, spark: SparkSession, exact: DataFrame) -> DataFrame:
    """Filters after ``changes`` (shard, key, op: 1 enter, -1 leave). ``exact``: shard, key
    of all keys that the filters hold then, for those that have to grow."""
    schema = "shard int, filter binary"
    load = lambda raw: CuckooFilter(table=np.frombuffer(raw, np.uint16).reshape(-1, CuckooFilter.SLOTS).copy())
    if old is None:
        def build(key, rows):
            return pd.DataFrame({"shard": [key[0]], "filter": [CuckooFilter.of(_as_array(rows["key"])).table.tobytes()]})
        return exact.groupBy("shard").applyInPandas(build, schema)

    def change(key, was, rows):
        f = load(was["filter"].iloc[0]) if len(was) else CuckooFilter(2 * len(rows))
        gone, new = (_as_array(rows.loc[rows["op"] == op, "key"]) for op in (-1, 1))
        f.delete(gone)
        full = not f.insert(new)
        return pd.DataFrame({"shard": [key[0]], "filter": [b"" if full else f.table.tobytes()]})
    changed = materialized(old.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(change, schema))
    grow = exact.join(changed.where(F.length("filter") == 0).select("shard"), "shard", "left_semi")
    return changed.where(F.length("filter") > 0).unionByName(_filters(grow, None, spark, grow))


def _state(postings: DataFrame, refs: DataFrame, before: LineState | None, min_chars: int, min_docs: int) -> LineState:
    """``refs`` (key, n_docs, keeper) and ``postings`` are stored already."""
    spark = refs.sparkSession
    repeated = refs.where(F.col("n_docs") >= min_docs)
    shards = max(before.shards if before else 8, -(-repeated.count() // SHARD_KEYS))
    sharded = _sharded(refs, shards)
    now = sharded.where(F.col("n_docs") >= min_docs).select("shard", "key")
    if before is None or shards != before.shards:
        filters = _filters(now, None, spark, now)
    else:
        was = before.refs.where(F.col("n_docs") >= min_docs).select("shard", "key")
        changes = (now.join(was, ["shard", "key"], "left_anti").withColumn("op", F.lit(1))
                   .unionByName(was.join(now, ["shard", "key"], "left_anti").withColumn("op", F.lit(-1))))
        filters = _filters(changes, before.filters, spark, now)
    return LineState(postings, sharded, materialized(filters), shards, min_chars, min_docs)


def insert(docs: DataFrame, state: LineState | None = None, *, id_col: str = "doc_id", text: str = "text",
           min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> LineState:
    """The state with the documents' lines added; lines that the state already has for
    a document count once."""
    if state:
        min_chars, min_docs = state.min_chars, state.min_docs
    found = line_keys(docs, min_chars, id_col=id_col, text=text).dropDuplicates(["key", "doc"])
    if state is None:
        postings = materialized(found)
        return _state(postings, materialized(_counts(postings)), None, min_chars, min_docs)
    new = materialized(found.join(state.postings, ["key", "doc"], "left_anti"))
    refs = (state.refs.select("key", "n_docs", "keeper").unionByName(_counts(new))
            .groupBy("key").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper")))
    return _state(materialized(state.postings.unionByName(new.select("doc", "key"))), materialized(refs), state, min_chars, min_docs)


def delete(ids: DataFrame, state: LineState, *, id_col: str = "doc_id") -> LineState:
    """The state without the documents whose ids are in ``ids``."""
    gone = ids.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc")).distinct()
    postings = materialized(state.postings.join(gone, "doc", "left_anti").select("doc", "key"))
    touched = state.postings.join(gone, "doc", "left_semi").select("key").distinct()
    again = _counts(postings.join(touched, "key", "left_semi"))
    refs = (state.refs.join(touched, "key", "left_anti").select("key", "n_docs", "keeper").unionByName(again))
    return _state(postings, materialized(refs), state, state.min_chars, state.min_docs)


def _probed(keys: DataFrame, state: LineState) -> DataFrame:
    """The rows of ``keys`` (doc, key) that their shard's filter may hold. A shard's keys are dealt out in pieces,
    each of which meets a copy of the filter (under a MB)."""
    keys = materialized(_sharded(keys, state.shards))
    pieces = keys.groupBy("shard").agg(F.ceil(F.count("*") / PIECE).alias("pieces"))
    cut = keys.join(pieces, "shard").withColumn("piece", F.pmod(F.monotonically_increasing_id(), "pieces")).drop("pieces")
    filters = state.filters.join(pieces, "shard").select("shard", "filter", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("piece"))

    def probe(rows: pa.Table, held: pa.Table) -> pa.Table:
        rows = rows.select(["doc", "key"])
        if not len(rows) or not len(held):
            return rows.slice(0, 0)
        table = np.frombuffer(held.column("filter")[0].as_py(), np.uint16).reshape(-1, CuckooFilter.SLOTS)
        return rows.filter(pa.array(CuckooFilter(table=table).contains(_as_array(rows.column("key").to_pylist()))))
    schema = T.StructType([T.StructField("doc", T.LongType()), T.StructField("key", T.BinaryType())])
    return cut.groupBy("shard", "piece").cogroup(filters.groupBy("shard", "piece")).applyInArrow(probe, schema)


def drop_lines(docs: DataFrame, state: LineState, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without the lines that the state drops (null texts stay null),
    with ``n_lines`` (before) and ``n_dropped``."""
    filters = None
    size = state.filters.agg(F.sum(F.length("filter"))).first()[0] or 0
    if size <= FILTER_BYTES:
        filters = {r["shard"]: CuckooFilter(table=np.frombuffer(bytes(r["filter"]), np.uint16).reshape(-1, CuckooFilter.SLOTS))
                   for r in state.filters.collect()}
    maybe = line_keys(docs, state.min_chars, id_col=id_col, text=text, filters=filters, shards=state.shards)
    if filters is None:
        maybe = _probed(maybe, state)
    repeated = state.refs.where(F.col("n_docs") >= state.min_docs).select("key", "keeper")
    drops = materialized(maybe.join(repeated, "key").where("doc != keeper").groupBy("doc").agg(F.collect_set("key").alias("_drop")))
    added = ["n_lines", "n_dropped"]
    keep = [c for c in docs.columns if c not in added]
    rows = docs.select(*keep)
    doc, gone_by = fresh(rows, "_doc"), fresh(rows, "_drop")
    joined = rows.join(drops.select(F.col("doc").alias(doc), F.col("_drop").alias(gone_by)).hint("shuffle_hash"),
                       F.col(id_col).cast("long") == F.col(doc), "left").select(*keep, gone_by)
    schema = T.StructType([*(rows.schema[c] for c in keep), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    least = state.min_chars

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column, drop = b.column(text), b.column(gone_by)
            n_lines, n_dropped, changed = [], [], {}
            for i, data in enumerate(utf8(column)):
                n, gone = data.count(b"\n") + 1, 0
                if drop[i].is_valid:
                    keys = {bytes(k) for k in drop[i].as_py()}
                    lines = data.split(b"\n")
                    left = [x for x in lines if line_key(x, least) not in keys]
                    gone = n - len(left)
                    changed[i] = b"\n".join(left)
                n_lines.append(n)
                n_dropped.append(gone)
            if changed:
                values = column.to_pylist()
                for i, v in changed.items():
                    values[i] = v.decode()
                column = pa.array(values, column.type)
            yield pa.RecordBatch.from_arrays([*(column if c == text else b.column(c) for c in keep),
                                              pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=[*keep, *added])
    return joined.mapInArrow(run, schema)


__all__ = ["CuckooFilter", "LineState", "delete", "drop_lines", "insert", "line_key", "line_keys"]
