"""Packing documents into fixed windows by the sum-of-squares rule.

A document is its token ids followed by ``end_id``. Whole windows are cut off
its front; the rest (under one window) is placed online: with N(h) the number
of open windows filled to level h, a rest of s tokens goes to the open window
(or a new one) for which the sum of N(h)^2 over all levels 1..size-1 becomes
least; ties go to the fuller window. The level array holds N and, for each
level, the open windows.

Windows that never fill are closed by cutting: rests from the emptiest open
windows fill the gaps of the fullest. At the end of a task all are closed so. Whenever
``max_open`` windows are open, the fullest thirty-second of them is, and the other
windows stay in the level array; so a task holds at most that many
windows in memory. What is left of a task (under one window) is cut into
windows whose lengths are powers of two, which need no padding.

Each task packs its own rows in their order; there is no shuffle. Window
numbers are unique over all tasks.

Defined results: null and empty texts are the single id ``end_id``; repeated
rows are packed each on their own; an empty table gives no pieces; null ids of
documents are kept; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SIZE = 1024
MAX_OPEN = 2048


# -- tokens --------------------------------------------------------------------

#: Characters on which both tokenizer libraries agree about letters, numbers and white space.
_ODD = re.compile("[^\t\n\r -~¡-ɏΑ-ΡА-я–—‘-”…]")
_RUN = re.compile(r"\s\s")


def encoder(path: str, ranks_path: str | None = None) -> Callable[[str], list[int]]:
    """Text to ids by the ``tokenizers`` file at ``path``, as it is (the string of an added
    token is that token). With ``ranks_path``, the same vocabulary as tiktoken ranks, texts
    of ordinary characters without two white spaces in a row and without an added token's
    string go through tiktoken, where the look-ahead of the splitting pattern isn't needed:
    the same ids sooner."""
    from tokenizers import Tokenizer
    full = Tokenizer.from_file(path)
    if not ranks_path:
        return lambda text: full.encode(text, add_special_tokens=False).ids
    import base64

    import tiktoken
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    quick = tiktoken.Encoding("ranks", mergeable_ranks=ranks, special_tokens={}, pat_str=(
        r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"))

    added = [t.content for t in full.get_added_tokens_decoder().values()]

    def encode(text: str) -> list[int]:
        if _ODD.search(text) or _RUN.search(text) or any(t in text for t in added):
            return full.encode(text, add_special_tokens=False).ids
        return quick.encode_ordinary(text)
    return encode


# -- windows -------------------------------------------------------------------

#: (document key, first token in the document, ids)
Piece = tuple[object, int, np.ndarray]


class LevelArray:
    """Open windows by fill level."""

    def __init__(self, size: int = SIZE, max_open: int = MAX_OPEN):
        self.size, self.max_open, self.n_open = size, max_open, 0
        self.count = np.zeros(size + 1, dtype=np.int64)
        self.open: list[list[list[Piece]]] = [[] for _ in range(size)]

    def place(self, piece: Piece) -> Iterator[list[Piece]]:
        """Adds a piece; yields windows that are done."""
        s, b, n = len(piece[2]), self.size, self.count
        if s == b:
            yield [piece]
            return
        # change of the sum of squares for each level h = 0..b-s; h = 0 is a new window
        change = 2 * n[s:b + 1] + 1
        change[-1] = 0                            # a full window no longer counts
        change[1:] -= 2 * n[1:b - s + 1] - 1
        change[1:][n[1:b - s + 1] == 0] = np.iinfo(np.int64).max
        h = b - s - int(np.argmin(change[::-1]))
        window = self._take(h) if h else []
        window.append(piece)
        if h + s == b:
            yield window
            return
        self._open(h + s, window)
        if self.n_open >= self.max_open:
            yield from self.fill(self.max_open - max(1, self.max_open // 32))

    def _take(self, level: int) -> list[Piece]:
        self.count[level] -= 1
        self.n_open -= 1
        return self.open[level].pop()

    def fill(self, until: int) -> Iterator[list[Piece]]:
        """Fills the fullest windows with pieces of the emptiest, yielding them, until at most ``until`` are
        open; the others stay at their levels."""
        while self.n_open > max(1, until):
            used = np.flatnonzero(self.count[:self.size])
            level = int(used[-1])
            window, gap = self._take(level), self.size - level
            while gap and self.n_open:
                level = int(np.flatnonzero(self.count[:self.size])[0])
                other = self._take(level)
                while gap and other:
                    doc, start, ids = other.pop()
                    if len(ids) > gap:
                        keep = len(ids) - gap
                        other.append((doc, start, ids[:keep]))
                        start, ids = start + keep, ids[keep:]
                    window.append((doc, start, ids))
                    gap -= len(ids)
                    level -= len(ids)
                if other:
                    self._open(level, other)
            if gap:
                self._open(self.size - gap, window)
            else:
                yield window

    def _open(self, level: int, window: list[Piece]) -> None:
        self.open[level].append(window)
        self.count[level] += 1
        self.n_open += 1

    def close(self):
        """Yields full windows made of all open ones; returns what is left, under one window."""
        yield from self.fill(0)
        return [p for level in np.flatnonzero(self.count[:self.size]) for p in self._take(int(level))]


def powers_of_two(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """Cuts what is left into windows whose lengths are powers of two, longest first."""
    todo = list(pieces)
    left = sum(len(p[2]) for p in todo)
    while left:
        want, window = 1 << (left.bit_length() - 1), []
        left -= want
        while want:
            doc, start, ids = todo.pop(0)
            if len(ids) > want:
                todo.insert(0, (doc, start + want, ids[want:]))
                ids = ids[:want]
            window.append((doc, start, ids))
            want -= len(ids)
        yield window


def windows(docs: Iterator[tuple[object, np.ndarray]], size: int = SIZE, max_open: int = MAX_OPEN) -> Iterator[list[Piece]]:
    """All windows of a stream of (document key, ids)."""
    levels = LevelArray(size, max_open)
    for key, ids in docs:
        whole = len(ids) // size * size
        for at in range(0, whole, size):
            yield [(key, at, ids[at:at + size])]
        if whole < len(ids):
            yield from levels.place((key, whole, ids[whole:]))
    yield from powers_of_two((yield from levels.close()))


def pack(docs: DataFrame, *, tokenizer: str, ranks: str | None = None, id_col: str = "doc_id", text: str = "text",
         end_id: int = 0, size: int = SIZE, max_open: int = MAX_OPEN) -> DataFrame:
    """One row per piece: the document's id, ``start`` and ``length`` in its ids,
    ``ids`` (little-endian unsigned 32 bit), ``doc_tokens``, ``sequence_id``, ``offset``."""
    if size < 1 or size & (size - 1):
        raise ValueError("the window size must be a power of two")
    schema = T.StructType([
        docs.schema[id_col], T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(tokenizer, ranks), TaskContext.get().partitionId()

        def tokens():
            for b in batches:
                for key, value in zip(b.column(id_col), b.column(text)):
                    ids = np.array([*encode(value.as_py() or ""), end_id], dtype="<u4")
                    yield (key.as_py(), len(ids)), ids

        def batch(rows):
            key, start, ids, n, seq, offset = zip(*rows)
            return pa.RecordBatch.from_arrays([
                pa.array(key, key_type), pa.array(start, pa.int64()), pa.array(map(len, ids), pa.int64()),
                pa.array([i.tobytes() for i in ids], pa.binary()), pa.array(n, pa.int64()),
                pa.array(seq, pa.int64()), pa.array(offset, pa.int64())], names=schema.names)
        rows, held = [], 0
        for k, window in enumerate(windows(tokens(), size, max_open)):
            offset = 0
            for (key, n), start, ids in window:
                rows.append((key, start, ids, n, (task << 40) | k, offset))
                offset += len(ids)
            held += offset
            if held >= 1 << 20:
                yield batch(rows)
                rows, held = [], 0
        if rows:
            yield batch(rows)
    from pyspark.sql.pandas.types import to_arrow_type
    key_type = to_arrow_type(docs.schema[id_col].dataType)
    return docs.select(id_col, text).mapInArrow(run, schema)
