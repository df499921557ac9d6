"""Helpers shared by the operators of this subpackage: table readers, a bounded
deterministic sample, and word hashing over UTF-8 bytes with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, ``[\x20\x09-\x0D]``.
SPACES = " \t\n\x0b\x0c\r"
#: A word is a maximal run of other characters.
WORD = r"[^\x20\x09-\x0D]+"

#: Text bytes that one numpy step works on (cut at white space only).
BLOCK = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def bounded_sample(df: DataFrame, n: int, *keys: str, total: int | None = None) -> DataFrame:
    """At most ``n`` rows, the same ones in every run: those whose keys have the
    smallest hashes. Rows above a hash bound that leaves about 2 n rows are
    filtered out where they are read, so what is ordered doesn't grow with the data.
    ``total``: number of rows, if known."""
    total = df.count() if total is None else total
    share = (2 * n + 100) / max(1, total)
    if share < 1:
        df = df.where(F.xxhash64(*keys) < F.lit(int(share * 2 ** 64) - 2 ** 63))
    return df.orderBy(F.xxhash64(*keys), *keys).limit(n)


def n_words(text: Column) -> Column:
    """Number of words; null text: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# -- bytes of a string column --------------------------------------------------

def utf8(column: pa.Array | pa.ChunkedArray) -> Iterator[bytes]:
    """The values as UTF-8 bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    for v in column.cast(kind):
        yield v.as_py() or b""


def blocks(data: bytes) -> Iterator[bytes]:
    """The text in pieces of about ``BLOCK`` bytes, cut behind a newline or space."""
    if len(data) <= BLOCK:
        yield data
        return
    at = 0
    while at < len(data):
        end = min(len(data), at + BLOCK)
        if end < len(data):
            cut = max(data.rfind(b" ", at, end), data.rfind(b"\n", at, end))
            if cut < at:
                later = [p for p in (data.find(b" ", end), data.find(b"\n", end)) if p >= 0]
                cut = min(later) if later else len(data) - 1
            end = cut + 1
        yield data[at:end]
        at = end


# -- word hashes -----------------------------------------------------------------

_P = 0x9E3779B97F4A7C15 | 1
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_LOWER += np.uint64(1)
#: Bytes of a word for features: letters, digits and everything beyond ASCII.
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[48:58] = _IN_WORD[65:91] = _IN_WORD[97:123] = _IN_WORD[128:] = True

_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^j and P^-j modulo 2^64 for j up to n."""
    if not _POWERS or len(_POWERS[0]) < n + 1:
        size = max(n + 1, 1 << 16)
        inverse = pow(_P, -1, 1 << 64)
        _POWERS[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, b)]), dtype=np.uint64)
                      for b in (np.uint64(_P), np.uint64(inverse))]
    return _POWERS[0], _POWERS[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads all bits of a 64-bit hash (murmur finaliser)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(data: bytes, prefixes: tuple[int, ...] = ()) -> list[np.ndarray]:
    """A 64-bit hash of every word of a text block (A-Z lower-cased), then for
    each length in ``prefixes`` the hashes of the words' first bytes, for words
    longer than that. A word is a run of letters, digits and non-ASCII bytes."""
    buf = np.frombuffer(data, dtype=np.uint8)
    inside = np.zeros(len(buf) + 2, dtype=np.int8)
    inside[1:-1] = _IN_WORD[buf]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    power, inverse = _powers(len(buf))
    total = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_LOWER[buf] * power[:len(buf)], out=total[1:])
    out = [mix((total[end] - total[start]) * inverse[start])]
    for k in prefixes:
        s = start[end - start > k]
        out.append(mix((total[s + k] - total[s]) * inverse[s] + np.uint64(k)))
    return out
