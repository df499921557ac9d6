"""SentencePiece encoding and decoding with BPE models, by vectorised merge rounds.

Text becomes ``▁`` + the text with spaces as ``▁`` and is cut into words (``▁``s, then other
characters; no piece of a model crosses such a cut, which is checked when a model is read). All
words that a step has not met lie in one flat numpy array of symbols. A round

1. looks up what each pair of neighbours of a word merges into, and its rank (by score),
2. takes the least rank of each word (a segmented minimum),
3. merges at once, in every word, the pairs of that rank, from the left without overlap,
4. compacts the array, and drops the words that have no pair left.

The library merges one pair after another: least rank first, of equal ranks the leftmost. Merging
all pairs of the least rank at once gives the same unless a merge makes a pair that isn't of a
higher rank (scores that tie, as those of the pieces made of ``▁`` only). Every round checks its new
pairs, and a word that has such a pair goes on alone, one pair after another, with a heap.

Characters that no piece covers become the pieces of their UTF-8 bytes. Decoding joins the bytes of
the pieces, drops the first ``▁`` and reads the others as spaces; bytes that aren't UTF-8 give U+FFFD
each.

The model is read by the driver and broadcast (as large as its file, about 1 MB), so the tasks need
no file. A task holds one Arrow batch, one block of a text and a cache of at most ``CACHE`` words.

Defined results: null and empty texts give no ids, null or no ids decode to the empty text; white space and
control characters are characters like others; a long text is worked on in blocks (a single word
of any length is one block: about 60 bytes a character); repeated rows get equal results; an empty
table gives no rows. Both functions are columns, so names of other columns can't clash.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

SPACE = "▁"
#: A word; longer texts are cut between words into blocks of about this many characters.
WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
BLOCK = 1 << 18
#: Words of at most this many characters, and so many of them, are remembered by a task.
CACHE, CACHED_CHARS = 200_000, 64

_CHARS = 0x110000
_NONE = np.iinfo(np.int32).max


@dataclass
class Model:
    """Symbols are piece ids below ``n``; a character without a piece is ``n`` + its code point."""
    n: int
    surface: list[bytes]        # by id, as decoded
    kind: np.ndarray            # by id: NORMAL, BYTE, CONTROL or UNKNOWN
    rank: np.ndarray            # by id: place of the score, ties are equal
    char: np.ndarray            # code point -> symbol
    keys: np.ndarray            # sorted pairs, left * (n + _CHARS) + right
    made: np.ndarray            # symbol that a pair merges into
    byte: np.ndarray            # byte -> id
    control: frozenset[int]
    two: np.ndarray             # pieces of two characters (sorted keys)
    three: np.ndarray           # three neighbouring characters inside of a piece


NORMAL, BYTE, CONTROL, UNKNOWN = range(4)
UNKNOWN_SURFACE = " ⁇ ".encode()
#: Read with the library and with this module when a model is read; a model of another kind is refused.
PROBES = ("", " ", "a  b", " x ", "\tA\n", "▁", "é\x00\U0001F917 中", "ﬁ ①", "aaaaaaa    b")


def read_model(path: str) -> Model:
    """The BPE model at ``path``. Raises ValueError for models with normalisation, without a prefix
    or without byte pieces."""
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    pieces = [sp.id_to_piece(i) for i in range(n)]
    kind = np.array([BYTE if sp.is_byte(i) else CONTROL if sp.is_control(i) else UNKNOWN if sp.is_unknown(i) else NORMAL
                     for i in range(n)], np.int8)
    _, rank = np.unique([-sp.get_score(i) for i in range(n)], return_inverse=True)
    normal = {pieces[i]: i for i in np.flatnonzero(kind == NORMAL).tolist()}
    if any(SPACE in p.lstrip(SPACE) for p in normal):
        raise ValueError("a piece crosses the start of a word")
    char = np.arange(n, n + _CHARS, dtype=np.int32)
    for p, i in normal.items():
        if len(p) == 1:
            char[ord(p)] = i
    symbol = lambda s: normal[s] if s in normal else int(char[ord(s)]) if len(s) == 1 else None
    pairs = {}
    for p, i in normal.items():
        for cut in range(1, len(p)):
            left, right = symbol(p[:cut]), symbol(p[cut:])
            if left is not None and right is not None:
                pairs[left * (n + _CHARS) + right] = i
    keys = np.array(sorted(pairs), np.int64)
    byte = np.full(256, -1, np.int32)
    for i in np.flatnonzero(kind == BYTE).tolist():
        byte[int(pieces[i][1:-1], 16)] = i
    if (byte < 0).any():
        raise ValueError("the model has no byte pieces")
    surface = [bytes([int(p[1:-1], 16)]) if k == BYTE else b"" if k == CONTROL else UNKNOWN_SURFACE if k == UNKNOWN
               else p.replace(SPACE, " ").encode() for p, k in zip(pieces, kind.tolist())]
    model = Model(n, surface, kind, rank.astype(np.int32), char, keys, np.array([pairs[k] for k in keys.tolist()], np.int32), byte,
                  frozenset(np.flatnonzero(kind == CONTROL).tolist()),
                  np.array(sorted({_key(p) for p in normal if len(p) == 2}), np.int64),
                  np.array(sorted({_key(p[i:i + 3]) for p in normal for i in range(len(p) - 2)}), np.int64))
    encoder = Encoder(model)
    for text in PROBES:
        if next(encoder.ids([text])).tolist() != sp.encode(text) or decoded(model, sp.encode(text)) != sp.decode(sp.encode(text)):
            raise ValueError("not a byte-fallback BPE model with identity normalisation and a prefix")
    return model


def _key(s: str) -> int:
    key = 0
    for c in s:
        key = key << 21 | ord(c)
    return key


def _within(keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(x), bool)
    return keys[np.minimum(np.searchsorted(keys, x), len(keys) - 1)] == x


# -- merging ---------------------------------------------------------------------

def cut_points(m: Model, points: np.ndarray) -> np.ndarray:
    """Where a long word may be cut: places that no piece can cross. A piece across a place is two
    characters long or holds three neighbours around it."""
    p = points.astype(np.int64)
    pair = p[:-1] << 21 | p[1:]
    crossed = _within(m.two, pair)
    if len(p) > 2:
        inside = _within(m.three, pair[:-1] << 21 | p[2:])
        crossed[:-1] |= inside
        crossed[1:] |= inside
    return np.flatnonzero(~crossed) + 1


def _merged(m: Model, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """What pairs merge into; ``_NONE`` where they don't."""
    out = np.full(len(left), _NONE, np.int32)
    if not len(m.keys):
        return out
    step = 1 << 20
    for a in range(0, len(left), step):
        key = left[a:a + step].astype(np.int64) * (m.n + _CHARS) + right[a:a + step]
        at = np.minimum(np.searchsorted(m.keys, key), len(m.keys) - 1)
        hit = m.keys[at] == key
        out[a:a + step][hit] = m.made[at[hit]]
    return out


def _ranks(m: Model, made: np.ndarray) -> np.ndarray:
    return np.where(made == _NONE, np.int32(_NONE), m.rank[np.minimum(made, m.n - 1)])


def _one_by_one(m: Model, symbols: np.ndarray) -> np.ndarray:
    """Finishes one word pair by pair: least rank first, then the leftmost."""
    sym = symbols.tolist()
    pair = dict(zip(m.keys.tolist(), m.made.tolist())) if len(sym) > 64 else None
    wide = m.n + _CHARS

    def made(a: int, b: int) -> int:
        if pair is not None:
            return pair.get(a * wide + b, -1)
        at = int(np.searchsorted(m.keys, a * wide + b))
        return int(m.made[at]) if at < len(m.keys) and m.keys[at] == a * wide + b else -1
    rank, after, before = m.rank.tolist(), [*range(1, len(sym)), -1], [*range(-1, len(sym) - 1)]
    heap = []

    def offer(i: int, j: int) -> None:
        if i >= 0 and j >= 0 and (to := made(sym[i], sym[j])) >= 0:
            heapq.heappush(heap, (rank[to], i, j, sym[i], sym[j], to))
    for i in range(len(sym) - 1):
        offer(i, i + 1)
    while heap:
        _, i, j, a, b, to = heapq.heappop(heap)
        if sym[i] != a or sym[j] != b or after[i] != j:
            continue
        sym[i], sym[j] = to, -1
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        offer(before[i], i)
        offer(i, after[i])
    return np.array([s for s in sym if s >= 0], np.int32)


def merge_words(m: Model, sym: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The final symbols of all words, one word after another, and their numbers by word. ``sym`` holds
    the words' characters one after another, ``size`` (each at least 1) their numbers."""
    n_words, ids = len(size), np.arange(len(size))                        # ids: words not done yet
    out_sym, out_id, out_size = [], [], []

    def finish(symbols: np.ndarray, words: np.ndarray, sizes: np.ndarray) -> None:
        out_sym.append(symbols)
        out_id.append(words)
        out_size.append(sizes)
    last = np.zeros(len(sym), bool)                                       # the last symbol of a word has no pair
    last[np.cumsum(size) - 1] = True
    made = np.full(len(sym), _NONE, np.int32)                             # of a symbol and the next one
    inside = np.flatnonzero(~last)
    made[inside] = _merged(m, sym[inside], sym[inside + 1])
    rank = _ranks(m, made)
    while len(ids):
        least = np.minimum.reduceat(rank, np.cumsum(size) - size)
        done = least == _NONE
        if done.any():
            off = np.repeat(done, size)
            finish(sym[off], ids[done], size[done])
            sym, made, rank, last = sym[~off], made[~off], rank[~off], last[~off]
            ids, size, least = ids[~done], size[~done], least[~done]
            if not len(ids):
                break
        end = np.cumsum(size)
        bound = np.repeat(least, size)
        hit = np.flatnonzero(rank == bound)
        # from the left without overlap: every other pair of a run of adjacent ones
        first = np.ones(len(hit), bool)
        first[1:] = hit[1:] != hit[:-1] + 1
        run = np.flatnonzero(first)
        if len(run) < len(hit):
            hit = hit[(np.arange(len(hit)) - run[np.cumsum(first) - 1]) % 2 == 0]
        stay = np.ones(len(sym), bool)
        stay[hit + 1] = False
        ends = last.copy()
        ends[hit] = last[hit + 1]
        new_sym = sym.copy()
        new_sym[hit] = made[hit]
        new_sym, new_made, new_rank, new_last, bound_after = new_sym[stay], made[stay], rank[stay], ends[stay], bound[stay]
        new_size = np.add.reduceat(stay, end - size, dtype=np.int64)
        # the pairs that the merges changed
        place = hit - np.arange(len(hit))
        left = place[np.concatenate([[True], place[1:] != place[:-1] + 1])] - 1
        pairs = np.concatenate([place, left[left >= 0]])
        new_made[place] = new_rank[place] = _NONE
        pairs = pairs[~new_last[pairs]]
        new_made[pairs] = _merged(m, new_sym[pairs], new_sym[pairs + 1])
        new_rank[pairs] = _ranks(m, new_made[pairs])
        # words with a new pair that isn't of a higher rank, also beside a pair that merges later
        late = pairs[new_rank[pairs] <= bound_after[pairs]]
        bad = np.searchsorted(np.cumsum(new_size), late, "right")
        beside = np.flatnonzero(hit[1:] == hit[:-1] + 2)
        if len(beside):
            beside = beside[~last[hit[beside] + 1]]
            at = hit[beside]
            between = _ranks(m, _merged(m, made[at], sym[at + 2]))
            bad = np.concatenate([bad, np.searchsorted(end, at[between <= bound[at]], "right")])
        if len(bad):
            bad = np.unique(bad)
            for w in bad.tolist():
                whole = _one_by_one(m, sym[end[w] - size[w]:end[w]])
                finish(whole, ids[w:w + 1], np.array([len(whole)]))
            on = np.ones(len(ids), bool)
            on[bad] = False
            off = np.repeat(on, new_size)
            new_sym, new_made, new_rank, new_last = new_sym[off], new_made[off], new_rank[off], new_last[off]
            ids, new_size = ids[on], new_size[on]
        sym, made, rank, last, size = new_sym, new_made, new_rank, new_last, new_size
    # back into the order of the words
    if not n_words:
        return sym, size
    word, n = np.concatenate(out_id), np.concatenate(out_size)
    order = np.argsort(word)
    start = (np.cumsum(n) - n)[order]
    n = n[order]
    at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return np.concatenate(out_sym)[at], n


def _words(text: str) -> list[str]:
    """The words without their first ``▁``."""
    return [w[1:] for w in WORD.findall(text)]


class Encoder:
    """Texts to ids, remembering words."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> Iterator[bytes]:
        """The ids (int32) of each word, given without its first ``▁``."""
        m = self.model
        words = [SPACE + w for w in words]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        # long words in parts: fewer rounds, the same pieces
        ends, parts = np.cumsum(sizes), [np.zeros(0, np.int64)]
        for w in np.flatnonzero(sizes > CACHED_CHARS).tolist():
            a, b = ends[w] - sizes[w], ends[w]
            parts.append(a + cut_points(m, points[a:b]))
        bounds = np.sort(np.concatenate([[0], ends, *parts]))
        sym, n = merge_words(m, m.char[points], np.diff(bounds))
        n = np.add.reduceat(n, np.searchsorted(bounds, ends - sizes))
        odd = np.flatnonzero(sym >= m.n)
        if len(odd):
            # characters without a piece become the pieces of their bytes
            raw = [chr(c).encode("utf-8", "surrogatepass") for c in (sym[odd] - m.n).tolist()]
            wide = np.ones(len(sym), np.int64)
            wide[odd] = [len(r) for r in raw]
            n = np.add.reduceat(wide, np.cumsum(n) - n)
            spread = np.repeat(sym, wide)
            spread[spread >= m.n] = m.byte[np.frombuffer(b"".join(raw), np.uint8)]
            sym = spread
        data, ends = sym.astype(np.int32).tobytes(), (4 * np.cumsum(n)).tolist()
        return (data[a:b] for a, b in zip([0, *ends], ends))

    def _known(self, words: set[str]) -> dict[str, bytes]:
        """Ids of at least these words."""
        fresh = list(words.difference(self.known))
        if not fresh:
            return self.known
        learned = dict(zip(fresh, self._learn(fresh)))
        short = {w: i for w, i in learned.items() if len(w) <= CACHED_CHARS}
        if len(self.known) + len(short) > CACHE:
            learned.update((w, self.known[w]) for w in words.difference(learned))
            self.known = short if len(short) <= CACHE else {}
            return learned
        self.known.update(short)
        if len(short) == len(learned):
            return self.known
        learned.update((w, self.known[w]) for w in words.difference(learned))
        return learned

    def ids(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text. Short texts are read together, long ones in blocks."""
        group: list[list[str]] = []
        held = 0
        for text in texts:
            if held and held + len(text) > BLOCK:
                yield from self._together(group)
                group, held = [], 0
            if len(text) > BLOCK:
                text = SPACE + text.replace(" ", SPACE)
                yield np.concatenate([ids for block in self._blocks(text) for ids in self._together([_words(block)])])
                continue
            if not text:
                group.append([])
            elif text[0] == " " or "  " in text or SPACE in text:
                group.append(_words(SPACE + text.replace(" ", SPACE)))
            else:
                group.append(text.split(" "))
            held += len(text)
        yield from self._together(group)

    def _together(self, texts: list[list[str]]) -> Iterator[np.ndarray]:
        known = self._known(set(chain.from_iterable(texts)))
        return (np.frombuffer(b"".join(map(known.__getitem__, words)), np.int32) for words in texts)

    @staticmethod
    def _blocks(t: str) -> Iterator[str]:
        """Pieces of about ``BLOCK`` characters, cut where a word starts: at a ``▁`` behind another character."""
        at = 0
        while at < len(t):
            end = t.find(SPACE, at + BLOCK)
            while end >= 0 and t[end - 1] == SPACE:
                end = t.find(SPACE, end + 1)
            end = end if end >= 0 else len(t)
            yield t[at:end]
            at = end


def decoded(m: Model, ids: list[int]) -> str:
    """The text of ids."""
    parts = [m.surface[i] for i in ids]
    first = next((k for k, i in enumerate(ids) if m.kind[i] != CONTROL), None)
    if first is None:
        return ""
    if m.kind[ids[first]] == NORMAL and parts[first][:1] == b" ":
        parts[first] = parts[first][1:]
    try:
        if not m.control.isdisjoint(ids):
            raise ValueError
        return b"".join(parts).decode()
    except ValueError:
        # runs of byte pieces on their own, so that bytes on both sides of a control piece don't meet
        runs = groupby(zip(ids, parts), lambda p: m.kind[p[0]] == BYTE)
        return "".join(_lenient(b"".join(part for _, part in run)) for _, run in runs)


def _lenient(data: bytes) -> str:
    """UTF-8 with U+FFFD for every byte that isn't part of a character."""
    out = []
    while data:
        try:
            out.append(data.decode())
            break
        except UnicodeDecodeError as e:
            out += [data[:e.start].decode(), "\ufffd"]
            data = data[e.start + 1:]
    return "".join(out)


# -- columns -----------------------------------------------------------------------

def _texts(batch: pa.Array) -> Iterator[str]:
    return (v.as_py() or "" for v in batch)


def _id_lists(parts: Iterator[np.ndarray]) -> pa.ListArray:
    flat, ends = bytearray(), [0]
    for ids in parts:
        flat += ids.tobytes()
        ends.append(len(flat) // 4)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, np.int32)))


def _decoded(m: Model, ids: pa.ListArray) -> pa.Array:
    flat, ends = ids.flatten().to_numpy(zero_copy_only=False), [0]
    for n in ids.value_lengths().fill_null(0).to_pylist():
        ends.append(ends[-1] + n)
    return pa.array([decoded(m, flat[a:b].tolist()) for a, b in zip(ends, ends[1:])], pa.string())


def encode(text: Column, model: Model, spark: SparkSession) -> Column:
    """The ids (array of int) of a text column."""
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(shared.value)
        for batch in batches:
            yield _id_lists(encoder.ids(_texts(batch)))
    return F.arrow_udf(run, "array<int>")(text)


def decode(ids: Column, model: Model, spark: SparkSession) -> Column:
    """The text of a column of ids."""
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield _decoded(shared.value, batch)
    return F.arrow_udf(run, "string")(ids)


def encode_and_decode(text: Column, model: Model, spark: SparkSession) -> Column:
    """A struct of the ``ids`` of a text and of the text ``decoded`` from them, in one pass."""
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(shared.value)
        for batch in batches:
            ids = _id_lists(encoder.ids(_texts(batch)))
            yield pa.StructArray.from_arrays([ids, _decoded(shared.value, ids)], names=["ids", "decoded"])
    return F.arrow_udf(run, "struct<ids: array<int>, decoded: string>")(text)
