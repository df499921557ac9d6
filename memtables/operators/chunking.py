"""Chunking (ops 39-42): memory text -> chunk rows
``chunk_id, memory_id, space_id, chunk_index, chunk_text``.

* ``none``      whole text, one chunk;
* ``fixed``     windows of ``size`` characters, each starting ``size - overlap``
                after the last (SQL ``sequence`` + ``substring``);
* ``sentence``  sentences packed greedily up to ``size``; a longer sentence is
                cut into fixed windows; the overlap is the trailing whole
                sentences of the previous chunk that fit in ``overlap``
                (SQL ``aggregate`` with a struct accumulator);
* ``recursive`` paragraphs packed like sentences; a paragraph too long is
                packed from its lines, a line from its words, a word is cut
                into fixed windows (nested SQL ``aggregate``).

Sizes count characters (code points). Every strategy works per row, so the
work is spread like the memory table itself; no shuffle.
"""

from __future__ import annotations

import re

import pandas as pd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from memtables import schema as S
from memtables.operators.sizing import spread

# Our choices
# whitespace spelled out so that every regex engine reads it the same way
SENTENCE_PATTERN = r"[.!?]*[^.!?]+[.!?]*[ \t\n\x0B\f\r]*|[.!?]+[ \t\n\x0B\f\r]*"
# recursive levels: paragraphs, lines, words (each unit keeps its trailing
# separator; \z = end of text in every regex engine); then characters
RECURSIVE_LEVELS = (r"(?s).+?(?:\n\n+|\z)", r"(?s).+?(?:\n+|\z)", r"(?s).+?(?: +|\z)")


def chunk_id(memory_id: Column, index: Column) -> Column:
    return F.concat(memory_id.cast("string"), F.lit("-"), index.cast("string"))


def _explode(memories: DataFrame, pieces: Column, text_col: str, heavy: bool = False) -> DataFrame:
    cols = [c for c in ("memory_id", "space_id") if c in memories.columns]
    src = spread(memories) if heavy else memories      # folds are CPU-heavy; windows are not
    out = src.select(*cols, F.posexplode(pieces).alias("chunk_index", "chunk_text"))
    return out.select(chunk_id(F.col("memory_id"), F.col("chunk_index")).alias("chunk_id"),
                      *cols, F.col("chunk_index").cast("int").alias("chunk_index"), "chunk_text")


# -- 39 / 40 ----------------------------------------------------------------------

def fixed_windows(text: Column, size: int | Column, overlap: int | Column) -> Column:
    """array of windows: starts 0, step, 2*step, ... while start < len - overlap
    (at least one window), each ``size`` characters long.

    With literal sizes the text is cut once into blocks of ``step`` characters
    (one regex pass) and window i joins blocks i .. i+m-1: linear in the text,
    where ``substring`` at growing offsets would rescan the text each time."""
    t = F.coalesce(text, F.lit(""))
    if isinstance(size, int) and isinstance(overlap, int):
        step = size - overlap
        m = -(-size // step)
        blocks = F.regexp_extract_all(t, F.lit(f"(?s).{{1,{step}}}"), 0)

        def windows(b: Column) -> Column:
            # b is bound once (a lambda variable), not re-evaluated per window
            n = F.greatest(F.lit(1), F.ceil((F.aggregate(b, F.lit(0), lambda acc, x: acc + F.length(x))
                                             - overlap) / F.lit(step))).cast("int")
            return F.transform(F.sequence(F.lit(0), n - 1),
                               lambda i: F.substring(F.array_join(F.slice(b, i + 1, m), ""), 1, size))

        return F.transform(F.array(blocks), windows)[0]
    size = F.lit(size) if isinstance(size, int) else size
    overlap = F.lit(overlap) if isinstance(overlap, int) else overlap
    starts = F.sequence(F.lit(0), F.greatest(F.length(t) - overlap - 1, F.lit(0)), size - overlap)
    return F.transform(starts, lambda i: F.substring(t, i + 1, size))


def chunk_none(memories: DataFrame, text_col: str = "original_content") -> DataFrame:
    return _explode(memories, F.array(F.coalesce(F.col(text_col), F.lit(""))), text_col)


def chunk_fixed(memories: DataFrame, size: int = S.DEFAULT_CHUNK_SIZE,
                overlap: int = S.DEFAULT_CHUNK_OVERLAP, text_col: str = "original_content") -> DataFrame:
    _check(size, overlap)
    return _explode(memories, fixed_windows(F.col(text_col), size, overlap), text_col)


def _check(size: int, overlap: int) -> None:
    if size <= 0 or overlap < 0 or overlap >= size:
        raise ValueError(S.MSG_BAD_OVERLAP)


# -- 41 chunk_sentence -------------------------------------------------------------

def sentences(text: Column) -> Column:
    """Sentences whose concatenation is the text (nothing lost)."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(SENTENCE_PATTERN), 0)


def _column(n: int | Column) -> Column:
    return F.lit(n) if isinstance(n, int) else n


def _carry(tail: Column, overlap: int | Column, room: Column) -> Column:
    """Longest run of trailing sentences of ``tail`` (structs ``s, n``) whose
    total length is at most ``overlap`` and leaves ``room`` for the next one."""
    lim = F.least(_column(overlap), room)
    init = F.struct(F.array().cast("array<struct<s:string,n:int>>").alias("arr"), F.lit(0).alias("n"),
                    F.lit(True).alias("open"))

    def step(acc, x):
        fits = acc["open"] & (acc["n"] + x["n"] <= lim)
        return F.when(fits, F.struct(F.concat(F.array(x), acc["arr"]).alias("arr"),
                                     (acc["n"] + x["n"]).alias("n"), F.lit(True).alias("open"))) \
            .otherwise(F.struct(acc["arr"].alias("arr"), acc["n"].alias("n"), F.lit(False).alias("open")))

    return F.aggregate(F.reverse(tail), init, step)


def pack_units(units: Column, size: int | Column, overlap: int | Column, too_long) -> Column:
    """Greedy packing of text units (whose concatenation is the text) into
    chunks of at most ``size`` characters. A unit longer than ``size`` is
    handed to ``too_long`` (unit -> array of chunks) after the current chunk
    is flushed; the overlap is the trailing whole units of the previous chunk
    that fit in ``overlap``. Lengths are computed once per unit and carried in
    the accumulator. Returns the chunks (possibly empty)."""
    item = "struct<s:string,n:int>"
    items = F.transform(units, lambda x: F.struct(x.alias("s"), F.length(x).alias("n")))
    init = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"),
                    F.lit(0).alias("cur_n"), F.array().cast(f"array<{item}>").alias("tail"))

    def state(done, cur, cur_n, tail):
        return F.struct(done.alias("done"), cur.alias("cur"), cur_n.alias("cur_n"), tail.alias("tail"))

    def step(acc, x):
        done, cur, cur_n, tail = acc["done"], acc["cur"], acc["cur_n"], acc["tail"]
        s, n = x["s"], x["n"]
        flushed = F.when(cur_n > 0, F.concat(done, F.array(cur))).otherwise(done)
        long_ = state(F.concat(flushed, too_long(s)), F.lit(""), F.lit(0), F.array().cast(f"array<{item}>"))
        start = state(done, s, n, F.array(x))
        grow = state(done, F.concat(cur, s), cur_n + n, F.concat(tail, F.array(x)))
        # the carried units are computed once and used through a lambda variable
        roll = F.transform(F.array(_carry(tail, overlap, _column(size) - n)), lambda c: state(
            F.concat(done, F.array(cur)),
            F.concat(F.array_join(F.transform(c["arr"], lambda y: y["s"]), ""), s),
            c["n"] + n, F.concat(c["arr"], F.array(x))))[0]
        return (F.when(n > size, long_)
                .when(cur_n == 0, start)
                .when(cur_n + n <= size, grow)
                .otherwise(roll))

    def finish(acc):
        return F.when(acc["cur_n"] > 0, F.concat(acc["done"], F.array(acc["cur"]))).otherwise(acc["done"])

    return F.aggregate(items, init, step, finish)


def _non_empty(chunks: Column) -> Column:
    """[''] for a text without chunks. ``chunks`` is bound once (a lambda
    variable): referenced twice it would be computed twice."""
    return F.transform(F.array(chunks), lambda c: F.when(F.size(c) == 0, F.array(F.lit("")))
                       .otherwise(c))[0]


def pack_sentences(text: Column, size: int | Column, overlap: int | Column) -> Column:
    """Sentences packed greedily; a sentence longer than ``size`` is cut into
    fixed windows."""
    return _non_empty(pack_units(sentences(text), size, overlap,
                                 lambda s: fixed_windows(s, size, overlap)))


def chunk_sentence(memories: DataFrame, size: int = S.DEFAULT_CHUNK_SIZE,
                   overlap: int = S.DEFAULT_CHUNK_OVERLAP, text_col: str = "original_content") -> DataFrame:
    _check(size, overlap)
    return _explode(memories, pack_sentences(F.col(text_col), size, overlap), text_col, heavy=True)


# -- 42 chunk_recursive -------------------------------------------------------------

def recursive_units(text: Column, level: int) -> Column:
    """Units of one level, each keeping its trailing separator (lossless)."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(RECURSIVE_LEVELS[level]), 0)


def split_recursive(text: Column, size: int, overlap: int, level: int = 0) -> Column:
    """Paragraphs packed up to ``size``; a paragraph too long is packed from
    its lines, a line too long from its words, a word too long is cut into
    fixed windows (characters). Same packing and overlap as sentences."""
    if level == len(RECURSIVE_LEVELS):
        return fixed_windows(text, size, overlap)
    return pack_units(recursive_units(text, level), size, overlap,
                      lambda s: split_recursive(s, size, overlap, level + 1))


# The same definition as a per-text helper: the word level packs one unit per
# word, which interpreted higher-order functions do about 10x slower than
# Python over Arrow batches (measured at sf0.1: 22 s against 2 s).
_PY_LEVELS = tuple(re.compile(p.replace("\\z", "\\Z")) for p in RECURSIVE_LEVELS)


def _py_fixed(t: str, size: int, overlap: int) -> list[str]:
    return [t[i:i + size] for i in range(0, max(len(t) - overlap - 1, 0) + 1, size - overlap)]


def _py_pack(units, size: int, overlap: int, too_long) -> list[str]:
    done: list[str] = []
    cur, tail = "", []
    for u in units:
        if len(u) > size:
            if cur:
                done.append(cur)
            done.extend(too_long(u))
            cur, tail = "", []
        elif not cur:
            cur, tail = u, [u]
        elif len(cur) + len(u) <= size:
            cur, tail = cur + u, tail + [u]
        else:
            done.append(cur)
            room, carry, n = min(overlap, size - len(u)), [], 0
            for x in reversed(tail):
                if n + len(x) > room:
                    break
                carry.insert(0, x)
                n += len(x)
            cur, tail = "".join(carry) + u, carry + [u]
    if cur:
        done.append(cur)
    return done


def py_split_recursive(text: str, size: int, overlap: int, level: int = 0) -> list[str]:
    if level == len(_PY_LEVELS):
        return _py_fixed(text, size, overlap)
    return _py_pack(_PY_LEVELS[level].findall(text), size, overlap,
                    lambda u: py_split_recursive(u, size, overlap, level + 1))


def _recursive_udf():
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def split(texts: pd.Series, sizes: pd.Series, overlaps: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else py_split_recursive(t, int(n), int(o)) or [""]
                          for t, n, o in zip(texts, sizes, overlaps)], index=texts.index, dtype=object)
    return split


def chunk_recursive(memories: DataFrame, size: int = S.DEFAULT_CHUNK_SIZE,
                    overlap: int = S.DEFAULT_CHUNK_OVERLAP, text_col: str = "original_content",
                    engine: str = "python") -> DataFrame:
    """``engine='python'``: the per-text helper over Arrow batches (default,
    faster); ``'sql'``: nested higher-order functions, all on the JVM."""
    _check(size, overlap)
    if engine == "sql":
        pieces = _non_empty(split_recursive(F.col(text_col), size, overlap))
    else:
        pieces = _recursive_udf()(F.coalesce(F.col(text_col), F.lit("")), F.lit(size), F.lit(overlap))
    return _explode(memories, pieces, text_col, heavy=True)


# -- by configuration ----------------------------------------------------------------

def chunk_by_config(memories: DataFrame, spaces: DataFrame, text_col: str = "original_content") -> DataFrame:
    """Each memory chunked with its space's chunking config, in one pass over the memories whatever the
    number of configs: strategy and sizes are columns. Memories of unknown spaces, unknown strategies and
    sizes that no space can have (overlap >= size) take the tool's default. ``spaces`` has one row per space."""
    cfg = spaces.select("space_id", F.struct("chunking.strategy", F.col("chunking.chunk_size").alias("size"),
                                             F.col("chunking.chunk_overlap").alias("overlap")).alias("config"))
    default = F.struct(F.lit(S.DEFAULT_CHUNKING_STRATEGY).alias("strategy"), F.lit(S.DEFAULT_CHUNK_SIZE).alias("size"), F.lit(S.DEFAULT_CHUNK_OVERLAP).alias("overlap"))
    c = F.col("config")
    sized = (c["size"] > 0) & (c["overlap"] >= 0) & (c["overlap"] < c["size"])
    good = c["strategy"].isin(*S.STRATEGIES) & ((c["strategy"] == S.STRATEGY_NONE) | sized)
    keyed = memories.select("memory_id", "space_id", F.col(text_col).alias("text")).join(cfg, "space_id", "left")
    keyed = spread(keyed).select("memory_id", "space_id", F.coalesce("text", F.lit("")).alias("text"),
                                 F.when(F.coalesce(good, F.lit(False)), c).otherwise(default).alias("config"))
    size, overlap, strategy = c["size"], c["overlap"], c["strategy"]
    # not deterministic for the optimizer, so that it isn't evaluated again in a filter on its result
    recursive = _recursive_udf().asNondeterministic()(F.when(strategy == S.STRATEGY_RECURSIVE, F.col("text")), size, overlap)
    pieces = (F.when(strategy == S.STRATEGY_NONE, F.array("text"))
              .when(strategy == S.STRATEGY_FIXED, fixed_windows(F.col("text"), size, overlap))
              .when(strategy == S.STRATEGY_SENTENCE, pack_sentences(F.col("text"), size, overlap))
              .otherwise(F.col("recursive")))
    return _explode(keyed.withColumn("recursive", recursive), pieces, "text")
