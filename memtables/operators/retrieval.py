"""Semantic retrieval: space keys (21), space restriction (30), exact top-k (35),
memory definitions (31).

Exact top-k per query is computed without materialising query x chunk pairs as
rows. Two physical forms, same answer:

* **blocks** (the default, any number of queries): the query rows are written once to the shared folder, in
  blocks of about 4 MiB sorted by space. A task holds 16 MiB of its chunks at a time, sorted once by space and
  id, and reads block after block from there, only those whose range of spaces meets its own. The chunk
  table is scanned once and never shuffled, and no query row passes through the driver. Where
  the table is laid out by ``space_bucket``, the folders to read come from the request table at run time
  (dynamic partition pruning).
  Where the candidates of one pass over the queries could be larger than the chunks that a task holds, the sides
  change places: the scanned chunks are written in blocks sorted by space, and a task holds 4 MiB of query
  rows, reads the blocks that meet their spaces and keeps the best k as it goes. Candidates are
  then at most k for each query row, however many chunks there are.
* **tiled**: the chunks of every searched space are cut into tiles
  of at most ``max_tile_chunks`` rows (salt = hash(chunk_id) mod n, n from the
  space's size), the queries of the space into blocks of at most
  ``max_tile_queries``. Each (space, chunk tile, query block) is one cogroup;
  a numpy matrix product scores it and only the local top k per query leaves
  the task. It moves the chunks once for each block of queries; kept as a second form to hold the first against.

Both end with one small shuffle by query id that keeps the best k of the local
candidates (score desc, chunk id asc).
"""

from __future__ import annotations

import urllib.parse
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from memtables import schema as S
from memtables.functions.text import java_trim
from memtables.operators import sizing as SZ
from memtables.operators.sizing import reduce_to_keys, scan_bytes
from memtables.session import materialized
from memtables.sources.files import BUCKETS, space_bucket

MAX_TILE_CHUNKS = 16_384
MAX_TILE_QUERIES = 4_096
# what a Python worker holds is a small multiple of these, at any size of the tables
QUERY_BLOCK_BYTES = 4 * 1024 * 1024    # query rows that a task holds at a time
_HELD_BYTES = 16 * 1024 * 1024    # chunk rows that a task holds while it goes through the blocks
_CANDIDATE_BYTES = 32             # of a candidate, as it is shuffled
_SCORE_BLOCK = 1_000_000          # scores held at once inside one task
_UNIT_ROWS = 4_096                # vectors brought to unit length at once
MAX_BROADCAST_SPACES = 1_000_000  # searched-space table rows allowed in a broadcast
MAX_PUSHED_SPACES = 1_000         # space list pushed to the scan as an IN filter
PUSH_FROM_BYTES = 64 * 1024 * 1024     # files below this are scanned whole
_SMALL_SPACE = 4_096              # scores up to which spaces are scored together
_PAIR_BYTES = 4 * 1024 * 1024     # of each side of the pairs scored together


# -- 21 parse_space_keys -----------------------------------------------------

def space_keys(space_ids: Column) -> Column:
    """``"id1, ,id2,"`` -> ``[id1, id2]``: Java-trimmed, empties dropped, order
    and repeats kept."""
    parts = F.transform(F.split(F.coalesce(space_ids, F.lit("")), ","), lambda x: java_trim(x))
    return F.filter(parts, lambda x: x != "")


def parse_space_keys(requests: DataFrame, col: str = "space_ids") -> DataFrame:
    """Adds ``space_keys`` and the outcome columns ``success`` / ``error``."""
    keys = space_keys(F.col(col))
    ok = F.size(keys) > 0
    return (requests.withColumn("space_keys", keys)
            .withColumn("success", ok)
            .withColumn("error", F.when(~ok, F.lit(S.MSG_NO_SPACE_ID))))


# -- 30 restrict_to_spaces ---------------------------------------------------

def restrict_to_spaces(requests: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per (query, distinct searched space); repeats do not double."""
    parsed = requests if "space_keys" in requests.columns else parse_space_keys(requests)
    return (parsed.select("query_id", *keep, F.explode(F.array_distinct("space_keys")).alias("space_id"))
            .dropDuplicates(["query_id", "space_id"]))


def chunks_in_spaces(chunks: DataFrame, query_spaces: DataFrame) -> DataFrame:
    """Chunks of the searched spaces only (left semi join on space_id)."""
    return chunks.join(query_spaces.select("space_id").distinct(), "space_id", "left_semi")


# -- 35 retrieve_topk --------------------------------------------------------

def _by_length(arr) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Arrow list<float> column -> {length: (positions, matrix of unit rows)}. The
    values are taken from the flat Arrow buffer (no per-row Python objects);
    null, empty and zero vectors are left out. Only vectors of equal length are
    ever compared."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks() if arr.num_chunks else pa.array([], type=arr.type)
    lens = pc.fill_null(pc.list_value_length(arr), 0).to_numpy(zero_copy_only=False)
    out = {}
    for d in np.unique(lens[lens > 0]).tolist():
        at = np.flatnonzero(lens == d)
        flat = pc.list_flatten(arr if len(at) == len(arr) else arr.take(pa.array(at))).to_numpy(zero_copy_only=False)
        m, n = np.empty((len(at), d), np.float64), 0
        for i in range(0, len(at), _UNIT_ROWS):
            some = np.nan_to_num(flat[i * d:(i + _UNIT_ROWS) * d].reshape(-1, d).astype(np.float64), copy=False)
            norms = np.linalg.norm(some, axis=1)
            ok = norms > 0
            at[n:n + ok.sum()] = at[i:i + _UNIT_ROWS][ok]
            m[n:n + ok.sum()] = some[ok] / norms[ok, None]
            n += ok.sum()
        if n:
            out[d] = (at[:n], m[:n])
    return out


def _topk_lengths(queries: dict, q_k: np.ndarray, chunks: dict):
    """:func:`_topk_block` for each vector length that both sides have; positions are
    those of the whole columns."""
    out_q, out_c, out_s = [], [], []
    for d in queries.keys() & chunks.keys():
        (q_at, q_mat), (c_at, c_mat) = queries[d], chunks[d]
        for q, c, s in _topk_block(q_mat, q_k[q_at], c_mat):
            out_q.append(q_at[q])
            out_c.append(c_at[c])
            out_s.append(s)
    return out_q, out_c, out_s


def _topk_block(q_mat: np.ndarray, q_k: np.ndarray, c_mat: np.ndarray, rounding: int = S.SCORE_DIGITS):
    """Best k chunks per query of one block, as (query positions, chunk positions,
    scores) of whole arrays. Chunks must be sorted by id: ties go to the first."""
    n_c = len(c_mat)
    most = int(min(q_k.max(initial=0), n_c))
    if most <= 0:
        return
    step = max(1, _SCORE_BLOCK // n_c)
    for start in range(0, len(q_mat), step):
        sims = q_mat[start:start + step] @ c_mat.T
        ranked = np.round(sims, rounding)
        least = np.partition(ranked, n_c - most, axis=1)[:, n_c - most]
        row, col = np.nonzero(ranked >= least[:, None])
        order = np.lexsort((col, -ranked[row, col], row))
        row, col = row[order], col[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < q_k[start + row]
        row, col = row[keep], col[keep]
        yield start + row, col, sims[row, col]


def _candidates_schema(queries: DataFrame, chunks: DataFrame) -> T.StructType:
    """Ids keep their type: strings stay strings, whole numbers become longs."""
    def kind(df: DataFrame, c: str) -> T.DataType:
        return T.StringType() if isinstance(df.schema[c].dataType, T.StringType) else T.LongType()
    return T.StructType([
        T.StructField("query_id", kind(queries, "query_id")),
        T.StructField("chunk_id", kind(chunks, "chunk_id")),
        T.StructField("memory_id", kind(chunks, "memory_id")),
        T.StructField("space_id", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("k", T.IntegerType()),
    ])


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    kinds = {T.StringType(): pa.string(), T.LongType(): pa.int64(), T.DoubleType(): pa.float64(), T.IntegerType(): pa.int32()}
    return pa.schema([(f.name, kinds[f.dataType]) for f in schema])


def _table(schema: pa.Schema, q_ids, q_k, chunks: pa.Table, res) -> pa.Table | None:
    out_q, out_c, out_s = res
    if not out_q:
        return None
    qpos = pa.array(np.concatenate(out_q))
    cpos = pa.array(np.concatenate(out_c))
    return pa.Table.from_arrays([
        q_ids.take(qpos).cast(schema.field("query_id").type),
        chunks.column("chunk_id").take(cpos).cast(schema.field("chunk_id").type),
        chunks.column("memory_id").take(cpos).cast(schema.field("memory_id").type),
        chunks.column("space_id").take(cpos).cast(pa.string()),
        pa.array(np.concatenate(out_s), pa.float64()),
        q_k.take(qpos).cast(pa.int32()),
    ], schema=schema)


def _sorted_by_id(chunks: pa.Table) -> pa.Table:
    return chunks.take(pc.sort_indices(chunks, sort_keys=[("chunk_id", "ascending")]))


def _tile_kernel(schema: pa.Schema):
    def tile(chunks: pa.Table, queries: pa.Table) -> pa.Table:
        if chunks.num_rows == 0 or queries.num_rows == 0:
            return schema.empty_table()
        chunks = _sorted_by_id(chunks)
        found = _topk_lengths(_by_length(queries.column("query_vector")), queries.column("k").to_numpy(), _by_length(chunks.column("embedding")))
        out = _table(schema, queries.column("query_id"), queries.column("k"), chunks, found)
        return schema.empty_table() if out is None else out
    return tile


ALL_SPACES = "*"                  # the search key of requests that search everything


def _query_rows(requests: DataFrame, default_k: int, all_spaces: bool) -> DataFrame:
    """One row per (request, searched space): query_id, query_vector, k, search_key."""
    if all_spaces:
        requests = requests.withColumn("space_keys", F.array(F.lit(ALL_SPACES)))
    parsed = requests if "space_keys" in requests.columns else parse_space_keys(requests)
    k = F.coalesce(F.col("max_results"), F.lit(default_k)) if "max_results" in parsed.columns \
        else F.lit(default_k)
    return (parsed.where(F.size("space_keys") > 0)
            .select("query_id", "query_vector", k.cast("int").alias("k"),
                    F.explode(F.array_distinct("space_keys")).alias("search_key")))


def _tiled(queries: DataFrame, chunks: DataFrame, schema: T.StructType,
           max_tile_chunks: int, max_tile_queries: int) -> tuple[DataFrame, int]:
    """Candidates of the tiled form, and the largest k asked."""
    q_counts = queries.groupBy("search_key").agg(F.count(F.lit(1)).alias("n_q"), F.max("k").alias("k_max"))
    # one small job: the number of searched spaces (the broadcast bound) and the largest k
    st = q_counts.agg(F.count(F.lit(1)).alias("n"), F.max("k_max").alias("k")).first()
    small = st["n"] <= MAX_BROADCAST_SPACES
    q_side_counts = F.broadcast(q_counts) if small else q_counts
    searched = chunks.join(q_side_counts.select("search_key"), "search_key")   # semi-join effect
    c_counts = searched.groupBy("search_key").agg(F.count(F.lit(1)).alias("n_c"))
    tiles = c_counts.join(q_side_counts, "search_key").select(
        "search_key",
        F.ceil(F.col("n_c") / F.lit(max_tile_chunks)).cast("int").alias("n_ct"),
        F.ceil(F.col("n_q") / F.lit(max_tile_queries)).cast("int").alias("n_qt"),
    )
    # tiles has at most one row per searched space: the same proven bound
    tiles = F.broadcast(tiles) if small else tiles
    c_side = (chunks.join(tiles, "search_key")
              .withColumn("ct", F.pmod(F.xxhash64("chunk_id"), F.col("n_ct")).cast("int"))
              .withColumn("qt", F.explode(F.sequence(F.lit(0), F.col("n_qt") - 1)))
              .select("search_key", "ct", "qt", "chunk_id", "memory_id", "space_id", "embedding"))
    q_side = (queries.join(tiles, "search_key")
              .withColumn("qt", F.pmod(F.xxhash64("query_id"), F.col("n_qt")).cast("int"))
              .withColumn("ct", F.explode(F.sequence(F.lit(0), F.col("n_ct") - 1)))
              .select("search_key", "ct", "qt", "query_id", "query_vector", "k"))
    cands = (c_side.groupBy("search_key", "ct", "qt")
             .cogroup(q_side.groupBy("search_key", "ct", "qt"))
             .applyInArrow(_tile_kernel(_arrow_schema(schema)), schema))
    return cands, int(st["k"] or 1)


class _Side:
    """Chunks or queries of one step, sorted by space and id; vectors by length."""

    def __init__(self, rows: pa.Table, id_name: str, vector: str):
        if rows.column("search_key").null_count:
            rows = rows.filter(pc.is_valid(rows.column("search_key")))
        rows = rows.take(pc.sort_indices(rows, sort_keys=[("search_key", "ascending"), (id_name, "ascending")]))
        self.by_length = _by_length(rows.column(vector))
        self.rows = rows.drop_columns([vector])
        key = rows.column("search_key").combine_chunks() if rows.num_rows else pa.array([], pa.string())
        first = np.flatnonzero(np.concatenate([[True], pc.not_equal(key.slice(1), key.slice(0, len(key) - 1)).to_numpy(zero_copy_only=False)])) \
            if len(key) else np.zeros(0, np.int64)
        self.spaces = key.take(pa.array(first, pa.int64())).to_numpy(zero_copy_only=False)
        self.first = np.append(first, len(key))


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (count numbers) for each start, one after another."""
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(start, count)


def _topk_pairs(q_mat: np.ndarray, q_k: np.ndarray, q_first, q_n, c_mat: np.ndarray, c_first, c_n):
    """Best k chunks per query of many small spaces at once: rows ``q_first`` .. of the queries with
    rows ``c_first`` .. of the chunks, space by space."""
    width = 8 * max(q_mat.shape[1], 1)
    step = np.cumsum(q_n * c_n * width) // _PAIR_BYTES
    for part in np.split(np.arange(len(q_n)), np.flatnonzero(np.diff(step)) + 1):
        rows = _ranges(q_first[part], q_n[part])
        each = np.repeat(c_n[part], q_n[part])
        q, c = np.repeat(rows, each), _ranges(np.repeat(c_first[part], q_n[part]), each)
        sims = np.einsum("ij,ij->i", q_mat[q], c_mat[c])
        order = np.lexsort((c, -np.round(sims, S.SCORE_DIGITS), q))
        q, c, sims = q[order], c[order], sims[order]
        keep = np.arange(len(q)) - np.searchsorted(q, q) < q_k[q]
        yield q[keep], c[keep], sims[keep]


def _topk_spaces(queries: _Side, chunks: _Side):
    """Best k chunks per query row, of its own space; (query rows, chunk rows, scores)."""
    k = queries.rows.column("k").to_numpy()
    out_q, out_c, out_s = [], [], []
    _, qi, ci = np.intersect1d(queries.spaces, chunks.spaces, assume_unique=True, return_indices=True)
    for d in queries.by_length.keys() & chunks.by_length.keys() if len(qi) else ():
        (q_at, q_mat), (c_at, c_mat) = queries.by_length[d], chunks.by_length[d]
        q_first, c_first = np.searchsorted(q_at, queries.first[qi]), np.searchsorted(c_at, chunks.first[ci])
        q_n, c_n = np.searchsorted(q_at, queries.first[qi + 1]) - q_first, np.searchsorted(c_at, chunks.first[ci + 1]) - c_first
        small = q_n * c_n <= _SMALL_SPACE

        def add(found, q0: int, c0: int) -> None:
            for q, c, s in found:
                out_q.append(q_at[q0 + q])
                out_c.append(c_at[c0 + c])
                out_s.append(s)
        for i in np.flatnonzero(~small).tolist():
            q0, c0 = q_first[i], c_first[i]
            add(_topk_block(q_mat[q0:q0 + q_n[i]], k[q_at[q0:q0 + q_n[i]]], c_mat[c0:c0 + c_n[i]]), q0, c0)
        some = np.flatnonzero(small & (q_n > 0) & (c_n > 0))
        if len(some):
            add(_topk_pairs(q_mat, k[q_at], q_first[some], q_n[some], c_mat, c_first[some], c_n[some]), 0, 0)
    return out_q, out_c, out_s


_LAST_BLOCK: dict[tuple[str, ...], _Side] = {}


def open_parquet(uri: str) -> pq.ParquetFile:
    """A file of the shared folder, inside a task."""
    if uri.startswith("file:"):
        return pq.ParquetFile(urllib.parse.unquote("/" + uri[len("file:"):].lstrip("/")))
    if "://" not in uri:
        return pq.ParquetFile(uri)
    fs, path = pa.fs.FileSystem.from_uri(uri)
    return pq.ParquetFile(fs.open_input_file(path))


def _block(files: tuple[str, ...], spaces: np.ndarray, id_name: str = "query_id", vector: str = "query_vector") -> _Side | None:
    """A stored block, or None if none of its rows is of ``spaces`` (sorted). A task remembers the last one."""
    if files not in _LAST_BLOCK:
        opened = [open_parquet(f) for f in files]
        meets = False
        for f in opened:
            at = f.schema_arrow.get_field_index("search_key")
            for g in range(f.metadata.num_row_groups):
                range_of = f.metadata.row_group(g).column(at).statistics
                if range_of is None or not range_of.has_min_max:
                    meets = True
                else:
                    meets |= np.searchsorted(spaces, range_of.max, "right") > np.searchsorted(spaces, range_of.min)
        if not meets:
            return None
        _LAST_BLOCK.clear()
        _LAST_BLOCK[files] = _Side(pa.concat_tables([f.read() for f in opened]), id_name, vector)
    return _LAST_BLOCK[files]


def _by_space(stored: DataFrame, id_name: str, vector: str, n_blocks: int) -> DataFrame:
    """Rows of a written table, written in ``n_blocks`` files sorted by space; a large space is in many of them."""
    by_space = stored.repartitionByRange(n_blocks, "search_key", id_name, F.xxhash64(vector))
    return materialized(by_space.sortWithinPartitions("search_key", id_name))


def _n_blocks(n: int, d: int | None, block_bytes: int) -> int:
    return -(-n * (8 * max(d or 1, 1) + 96) // block_bytes)


def _blocks(queries: DataFrame, chunks: DataFrame, schema: T.StructType) -> tuple[DataFrame, int]:
    """Candidates of the form with stored blocks, and the largest k asked."""
    stored = materialized(queries)
    st = stored.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("query_vector")).alias("d"), F.max("k").alias("k")).first()
    k_max = max(st["k"] or 1, 1)
    n_blocks = _n_blocks(st["n"], st["d"], QUERY_BLOCK_BYTES)
    held_rows = _HELD_BYTES // (8 * max(st["d"] or 1, 1) + 96)
    if st["n"] * min(k_max, held_rows) * _CANDIDATE_BYTES > _HELD_BYTES:
        cores = queries.sparkSession.sparkContext.defaultParallelism
        stored = _by_space(stored, "query_id", "query_vector", max(n_blocks, 2 * cores))
        return _chunk_blocks(stored, _searched_only(chunks, stored), schema, k_max), k_max
    if n_blocks > 1:
        stored = _by_space(stored, "query_id", "query_vector", n_blocks)
    files = sorted(stored.inputFiles()) if st["n"] else []
    blocks = [(f,) for f in files] if n_blocks > 1 else [tuple(files)] if files else []
    chunks = _searched_only(chunks, stored)
    out_schema = _arrow_schema(schema)

    def score(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side = _Side(pa.Table.from_batches(held), "chunk_id", "embedding")
        held.clear()
        for files in blocks:
            queries = _block(files, side.spaces)
            if queries is not None:
                found = _table(out_schema, queries.rows.column("query_id"), queries.rows.column("k"), side.rows, _topk_spaces(queries, side))
                if found is not None:
                    yield from _prune(found).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= _HELD_BYTES:
                yield from score(held)
                held, size = [], 0
        if held:
            yield from score(held)
    return chunks.mapInArrow(run, schema), k_max


def _chunk_blocks(queries: DataFrame, chunks: DataFrame, schema: T.StructType, k_max: int) -> DataFrame:
    """Candidates with the chunks in stored blocks: of each query row, at most its best k."""
    stored = materialized(chunks.where("search_key is not null"))
    st = stored.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("d")).first()
    n_blocks = max(_n_blocks(st["n"], st["d"], _HELD_BYTES), 1)
    blocks = [(f,) for f in sorted(_by_space(stored, "chunk_id", "embedding", n_blocks).inputFiles())] if st["n"] else []
    out_schema = _arrow_schema(schema)
    step = max(1, _HELD_BYTES // (_CANDIDATE_BYTES * k_max))     # query rows whose candidates a task holds

    def score(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side = _Side(pa.Table.from_batches(held), "query_id", "query_vector")
        held.clear()
        best = out_schema.empty_table()
        for files in blocks:
            chunks = _block(files, side.spaces, "chunk_id", "embedding")
            if chunks is not None:
                found = _table(out_schema, side.rows.column("query_id"), side.rows.column("k"), chunks.rows, _topk_spaces(side, chunks))
                if found is not None:
                    best = _prune(pa.concat_tables([best, found]))
        yield from best.to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, n = [], 0, 0
        for batch in batches:
            for i in range(0, batch.num_rows, step):
                part = batch.slice(i, step)
                held.append(part)
                size, n = size + part.nbytes, n + part.num_rows
                if size >= QUERY_BLOCK_BYTES or n >= step:
                    yield from score(held)
                    held, size, n = [], 0, 0
        if held:
            yield from score(held)
    return queries.mapInArrow(run, schema)


def _searched_only(chunks: DataFrame, stored: DataFrame) -> DataFrame:
    """``chunks`` without folders and row groups that no request searches, where that is known before the scan."""
    if "space_bucket" in chunks.columns:
        # as many rows as the table has folders; the filter that is always true lets Spark prune by them
        asked = stored.select(F.col("search_bucket").alias("asked")).distinct().where("asked >= 0")
        return chunks.join(F.broadcast(asked), chunks["space_bucket"] == asked["asked"], "left_semi").drop("space_bucket")
    if scan_bytes(chunks) > PUSH_FROM_BYTES:
        spaces = [r[0] for r in stored.select("search_key").distinct().limit(MAX_PUSHED_SPACES + 1).collect()]
        if len(spaces) <= MAX_PUSHED_SPACES and ALL_SPACES not in spaces:
            return chunks.where(F.col("search_key").isin(sorted(spaces)))
    return chunks


def _prune(cands: pa.Table) -> pa.Table:
    """Keep the best k per query within one task (k of the query)."""
    if cands.num_rows == 0:
        return cands
    pdf = cands.to_pandas()
    pdf["_r"] = pdf["score"].round(S.SCORE_DIGITS)
    pdf = pdf.sort_values(["query_id", "_r", "chunk_id"], ascending=[True, False, True])
    keep = pdf.groupby("query_id").cumcount() < pdf["k"]
    return pa.Table.from_pandas(pdf[keep].drop(columns="_r"), schema=cands.schema, preserve_index=False)


def rank_candidates(cands: DataFrame, k_max: int | None = None) -> DataFrame:
    """Global best k per query from local candidates (column ``k``): one
    shuffle by query id. With ``k_max`` (the largest k asked) as a literal
    bound, Spark plans a partial per-task group limit before the shuffle."""
    score = F.round("score", S.SCORE_DIGITS)
    w = Window.partitionBy("query_id").orderBy(score.desc(), F.col("chunk_id").asc())
    ranked = cands.withColumn("score", score).withColumn("rank", F.row_number().over(w))
    if k_max is not None:
        ranked = ranked.where(F.col("rank") <= int(k_max))
    return ranked.where(F.col("rank") <= F.col("k")).drop("k")


def retrieve_topk(requests: DataFrame, chunks: DataFrame, *, default_k: int = S.DEFAULT_MAX_RESULTS,
                  method: str = "auto", space_buckets: int = BUCKETS, max_tile_chunks: int = MAX_TILE_CHUNKS,
                  max_tile_queries: int = MAX_TILE_QUERIES, all_spaces: bool = False) -> DataFrame:
    """For each request, the k most similar chunks (cosine) of its spaces
    (``all_spaces``: of the whole table, without a space list).

    ``requests``: query_id, query_vector, space_ids (or space_keys), max_results.
    ``chunks``: chunk_id, memory_id, space_id, embedding.
    Returns query_id, rank (1..k), chunk_id, memory_id, space_id, score
    (rounded to 6 digits; ties by chunk id).

    ``chunks`` may keep the folder column of a written table (``read_memory_table(..., layout=True)``, written
    with ``space_buckets``); only the folders of searched spaces are read then.

    ``method``: ``blocks`` (also ``auto``) or ``tiled``. Both give the same rows: vectors are compared with vectors of their own length; null, empty and
    zero vectors match nothing; ids may be strings or whole numbers.
    """
    if method not in ("auto", "blocks", "tiled"):
        raise ValueError(f"unknown method {method!r}")
    queries = _query_rows(requests, default_k, all_spaces)
    key = F.lit(ALL_SPACES) if all_spaces else F.col("space_id")
    laid_out = "space_bucket" in chunks.columns and not all_spaces and method != "tiled"
    if laid_out:
        queries = queries.withColumn("search_bucket", space_bucket(F.col("search_key"), space_buckets))
    chunks = chunks.select("chunk_id", "memory_id", "space_id", "embedding", key.alias("search_key"), *(["space_bucket"] if laid_out else []))
    schema = _candidates_schema(queries, chunks)
    if method == "tiled":
        cands, k_max = _tiled(queries, chunks, schema, max_tile_chunks, max_tile_queries)
    else:
        cands, k_max = _blocks(queries, chunks, schema)
    return rank_candidates(cands, k_max).select(
        "query_id", "rank", "chunk_id", "memory_id", "space_id", "score")


# -- 31 fetch_memory_definitions --------------------------------------------

def memory_index(results: DataFrame, order_col: str = "rank") -> DataFrame:
    """Adds ``memory_index``: the position of the result's memory in the
    query's list of memories, ordered by first appearance."""
    first = F.min(order_col).over(Window.partitionBy("query_id", "memory_id"))
    with_first = results.withColumn("_first", first)
    w = Window.partitionBy("query_id").orderBy("_first")
    return with_first.withColumn("memory_index", (F.dense_rank().over(w) - 1).cast("int")).drop("_first")


def fetch_memory_definitions(results: DataFrame, memories: DataFrame) -> DataFrame:
    """One row per (query, memory) in memory_index order, with the memory row
    attached (left join: a vanished memory keeps its index with nulls)."""
    idx = results if "memory_index" in results.columns else memory_index(results)
    per = idx.groupBy("query_id", "memory_id").agg(F.min("memory_index").alias("memory_index"))
    mem = memories.select("memory_id", F.col("space_id").alias("memory_space_id"),
                          "processing_status", "created_at")
    if scan_bytes(mem) > SZ.SEMI_JOIN_REDUCTION_BYTES:
        per = materialized(per)          # computed once, read by the key set and the join
        mem = reduce_to_keys(mem, per, "memory_id")
    return per.join(mem, "memory_id", "left")
