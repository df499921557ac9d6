"""Periodic runs of words: a suffix automaton whose link tree is recoloured word by word.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) and at least
max(``least``, 2 q) words that no neighbouring word extends keeping the period.

Which stretches can hold a run. A run of L >= max(least, 2 q) words repeats, q words on, its first L - q
words, so each of its words lies in a group of ceil(least / 2) words that the text holds twice. Groups are compared
by a rolling hash over the word numbers (numpy); equal groups have equal hashes, so no run is missed, and
chance matches only leave more to do. Each maximal covered stretch then goes through the
automaton; a stretch without repeats can't hold a run and doesn't.

Automaton. The states are the classes of a stretch's substrings with the same ends; the link tree's path from the state
of a prefix to the root holds all suffixes of the prefix. Each state on a path is coloured with
the last place where its strings ended. Appending word i accesses the path of prefix i: the segments of
one colour j on it are read and the whole path becomes one segment of colour i. A segment of colour j
that reaches strings of length n, with d = i - j <= n, is a square of period d: the n + d words that end at
i have period d, and d is the smallest (a smaller one would be a later place). If word i + 1 doesn't continue the period, the
stretch is a run: it can't be longer on the left either, as n would be. Every run is met at its last word.

The access is that of a link-cut tree. The tree is complete before the first access, so the
splay trees are stacks over heavy paths: a stack holds a heavy path's segments from the root's side down,
each access pops the segments above its state and pushes one. An access meets O(log n) heavy paths,
and every segment popped was pushed once.

Memory: 40 bytes a word for arrays and one dictionary for each state with several continuations.

Defined results: null and empty texts have no words and no runs; a text of any length is read whole, one
text at a time; repeated rows get equal results; an empty table gives no rows. The result is one column, so names
of other columns can't clash.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

LEAST = 12

_MIX = np.uint64(0x9E3779B97F4A7C15)


# -- stretches that can hold a run ---------------------------------------------------

def stretches(ids: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """(first, end) of the maximal stretches of at least ``least`` words in which every word lies in a
    group of ceil(least / 2) words that occurs twice."""
    size = (least + 1) // 2
    n = len(ids) - size + 1
    if n < 2 or len(ids) < least:
        return []
    word = (ids.astype(np.uint64) + np.uint64(1)) * _MIX
    word ^= word >> np.uint64(29)
    group = word[:n].copy()
    for k in range(1, size):
        group *= _MIX
        group += word[k:k + n]
    ordered = np.sort(group)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return []
    first = np.flatnonzero(np.isin(group, twice))
    # groups that touch or overlap cover one stretch
    gap = np.flatnonzero(first[1:] > first[:-1] + size)
    start = first[np.concatenate([[0], gap + 1])]
    end = first[np.concatenate([gap, [len(first) - 1]])] + size
    return [(a, b) for a, b in zip(start.tolist(), end.tolist()) if b - a >= least]


# -- suffix automaton -----------------------------------------------------------------

def suffix_automaton(word: list[int]) -> tuple[array, array, list[int]]:
    """Link and length of every state (0 is the root), and the state of each prefix."""
    n = len(word)
    link, length = array("i", bytes(8 * n + 4)), array("i", bytes(8 * n + 4))
    # most states go on with one word only; the others have a dictionary
    only, to, more = array("i", [-1]) * (2 * n + 1), array("i", bytes(8 * n + 4)), {}
    link[0], states, last, prefix = -1, 1, 0, []
    for c in word:
        new = states
        states += 1
        length[new] = length[last] + 1
        p, q = last, -1
        while p >= 0:
            if only[p] == c:
                q = to[p]
                break
            if only[p] < 0:
                only[p], to[p] = c, new
            else:
                ways = more.get(p)
                if ways is None:
                    more[p] = {c: new}
                else:
                    q = ways.get(c, -1)
                    if q >= 0:
                        break
                    ways[c] = new
            p = link[p]
        if q < 0:
            link[new] = 0
        elif length[q] == length[p] + 1:
            link[new] = q
        else:
            copy = states
            states += 1
            length[copy], link[copy], only[copy], to[copy] = length[p] + 1, link[q], only[q], to[q]
            if q in more:
                more[copy] = more[q].copy()
            while p >= 0:
                if only[p] == c:
                    if to[p] != q:
                        break
                    to[p] = copy
                else:
                    ways = more.get(p)
                    if ways is None or ways.get(c) != q:
                        break
                    ways[c] = copy
                p = link[p]
            link[q] = link[new] = copy
        prefix.append(new)
        last = new
    return link[:states], length[:states], prefix


def heavy_paths(link: array, length: array) -> array:
    """The uppermost state of each state's heavy path; the root is a path of its own."""
    n = len(link)
    order = np.argsort(np.frombuffer(length, np.int32), kind="stable").tolist()
    size, heavy, head = array("i", [1]) * n, array("i", [-1]) * n, array("i", range(n))
    for v in reversed(order[1:]):
        size[link[v]] += size[v]
    for v in order[1:]:
        p = link[v]
        if heavy[p] < 0 or size[v] > size[heavy[p]]:
            heavy[p] = v
    heavy[0] = -1
    for v in order[1:]:
        p = link[v]
        if heavy[p] == v:
            head[v] = head[p]
    return head


def runs_of(word: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a stretch, by start, then period."""
    link, length, prefix = suffix_automaton(word)
    head = heavy_paths(link, length)
    segments: dict[int, list[tuple[int, int]]] = {}    # heavy path -> (length reached, colour), root's side last
    found, end = [], len(word) - 1
    for i, v in enumerate(prefix):
        squares = None
        while v > 0:
            top, reach = head[v], length[v]
            stack = segments.get(top)
            if stack is None:
                segments[top] = [(reach, i)]
            else:
                while stack:
                    n, j = stack[-1]
                    if n > reach:
                        n = reach           # the lower part of this segment keeps its colour
                    else:
                        stack.pop()
                    d = i - j
                    if d <= n and n + d >= least:
                        if squares is None:
                            squares = {}
                        if squares.get(d, 0) < n:
                            squares[d] = n
                    if n == reach:
                        break
                stack.append((reach, i))
            v = link[top]
        if squares:
            for d, n in squares.items():
                if i == end or word[i + 1] != word[i + 1 - d]:
                    found.append((i + 1 - n - d, n + d, d))
    found.sort(key=lambda r: (r[0], r[2]))
    return found


def word_runs(words: list[bytes], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a text's words, by start, then period."""
    number: dict[bytes, int] = {}
    ids = [number.setdefault(w, len(number)) for w in words]
    if len(number) == len(ids):
        return []
    out = []
    for a, b in stretches(np.array(ids), least):
        out += [(a + start, n, q) for start, n, q in runs_of(ids[a:b], least)]
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, n, q in runs:
        depth[start + q] += 1
        depth[start + n] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


# -- column ------------------------------------------------------------------------

_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(text: Column, least: int = LEAST) -> Column:
    """A struct of ``runs`` (start, length, period: word numbers from 0; by start, then period) and
    ``collapsed``, the text's words outside of repeated periods joined by one space."""
    if least < 2:
        raise ValueError("a run has at least two words")

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            runs, kept = [], []
            for value in batch.cast(pa.binary()):
                words = (value.as_py() or b"").split()          # bytes: ASCII white space only
                found = word_runs(words, least)
                runs.append([{"start": a, "length": n, "period": q} for a, n, q in found])
                kept.append(b" ".join(collapsed(words, found)))
            yield pa.StructArray.from_arrays(
                [pa.array(runs, _RUNS), pa.array(kept, pa.binary()).cast(pa.string())], names=["runs", "collapsed"])
    return F.arrow_udf(run, "struct<runs: array<struct<start: bigint, length: bigint, period: bigint>>, collapsed: string>")(text)
