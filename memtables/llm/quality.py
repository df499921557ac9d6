"""Quality score by a factorisation machine.

Inputs of a row: its hashed words (presence, scaled so that the squares sum to
1), structure statistics of the whole text, and metadata columns given by the
caller. Every input i has a weight w_i and a vector v_i; the score is
``sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i (v_if x_i)^2))``,
all pairwise interactions in time linear in the number of inputs.

Training reads a bounded sample: at most ``max_rows`` labelled rows of each
class (smallest hashes of their ids); only ids for which ``may_train`` holds.
The model (2^``BITS`` words x (rank + 1) floats, under 3 MB) goes with the
scoring function. Scoring reads every whole text.

Defined results: null and empty texts have the statistics of an empty text and
get a score like any other; null metadata counts as 0; repeated rows get equal
scores; labels that disagree for an id count as 1; without labels of both classes
the score is the share of label 1 (0.5 without any). Extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from memtables.llm.common import blocks, bounded_sample, fresh, utf8, word_hashes

BITS = 16
RANK = 8
MAX_ROWS = 4000

_COUNT_OF = {"upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "space": b" \t\n\r",
             "symbol": b"#*$%&<>~^=@_", "bar": b"|{}[]", "stop": b".", "comma": b",;:", "mark": b"!?", "beyond": range(128, 256)}
_COUNTED = np.stack([np.isin(np.arange(256), list(v)) for v in _COUNT_OF.values()]).astype(np.float64)
N_STATS = 2 * len(_COUNT_OF) + 8


def four_grams(words: np.ndarray) -> np.ndarray:
    """A hash of every four words in a row."""
    n = max(0, len(words) - 3)
    return sum((words[k:k + n] * np.uint64(2 * k + 1) for k in range(4)), np.zeros(n, np.uint64))


def structure(data: bytes, words: np.ndarray) -> np.ndarray:
    """Statistics of a whole text, each about 0 to 1; ``words``: the hash of every word."""
    counts = np.zeros(256)
    for block in blocks(data):
        counts += np.bincount(np.frombuffer(block, np.uint8), minlength=256)
    n, n_words = max(1, len(data)), max(1, len(words))
    kinds = _COUNTED @ counts
    lines = [x for x in data.split(b"\n") if x.strip()]
    n_lines = max(1, len(lines))
    share = kinds / n
    fours = four_grams(words)
    more = [np.log1p(len(words)) / 10, len(set(lines)) / n_lines, min(1.0, n / n_words / 20),
            len(np.unique(words)) / n_words, np.log1p(len(lines)) / 8, min(1.0, n / n_lines / 500),
            1 - len(np.unique(fours)) / max(1, len(fours)), min(1.0, kinds[0] / max(1.0, kinds[0] + kinds[1]))]
    return np.concatenate([share, np.sqrt(share), more])


def inputs(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(distinct word buckets, structure statistics) of a whole text."""
    words = np.concatenate([word_hashes(b)[0] for b in blocks(data)]) if data else np.zeros(0, np.uint64)
    return np.unique(words >> np.uint64(64 - BITS)).astype(np.int32), structure(data, words)


@dataclass
class FactorisationMachine:
    """Rows 0..2^BITS-1 of ``w`` and ``v``: words; then the dense inputs, which are
    first centred by ``mean`` and divided by ``scale``."""
    w0: float
    w: np.ndarray
    v: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def dense(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.mean) / self.scale, -6, 6)

    def margin(self, words: np.ndarray, stats: np.ndarray) -> float:
        x = self.dense(stats)
        first = 1 << BITS
        y, s = self.w0 + x @ self.w[first:], x @ self.v[first:]
        q = (x * x) @ (self.v[first:] ** 2)
        if len(words):
            a = 1 / np.sqrt(len(words))
            rows = self.v[words]
            y += a * self.w[words].sum()
            s = s + a * rows.sum(axis=0)
            q = q + a * a * (rows * rows).sum(axis=0)
        return float(y + 0.5 * (s * s - q).sum())


def fit(words: list[np.ndarray], stats: np.ndarray, label: np.ndarray, weight: np.ndarray, *, rank: int = RANK,
        epochs: int = 24, batch: int = 256, rate: float = 0.02, l2: float = 2e-4, seed: int = 7) -> FactorisationMachine:
    """Adagrad on the weighted log-loss in mini-batches."""
    rng = np.random.default_rng(seed)
    first, n_dense = 1 << BITS, stats.shape[1]
    mean, scale = stats.mean(axis=0), stats.std(axis=0) + 1e-3
    fm = FactorisationMachine(float(np.log(np.average(label, weights=weight) / (1 - np.average(label, weights=weight)))),
                              np.zeros(first + n_dense, np.float32),
                              rng.normal(0, 0.01, (first + n_dense, rank)).astype(np.float32), mean, scale)
    dense = np.clip((stats - mean) / scale, -6, 6)
    gw, gv, g0 = np.full(len(fm.w), 1e-4), np.full(fm.v.shape, 1e-4), 1e-2
    for _ in range(epochs):
        order = rng.permutation(len(label))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            sizes = np.array([len(words[i]) for i in rows])
            col = np.concatenate([words[i] for i in rows]).astype(np.int64)
            row = np.repeat(np.arange(len(rows)), sizes)
            a = np.repeat(1 / np.sqrt(np.maximum(sizes, 1)), sizes)
            uniq, back = np.unique(col, return_inverse=True)
            x, vd = dense[rows], fm.v[first:]
            xv = a[:, None] * fm.v[col]
            s, q = x @ vd, (x * x) @ (vd * vd)
            for f in range(rank):
                s[:, f] += np.bincount(row, xv[:, f], minlength=len(rows))
                q[:, f] += np.bincount(row, xv[:, f] ** 2, minlength=len(rows))
            z = fm.w0 + x @ fm.w[first:] + np.bincount(row, a * fm.w[col], minlength=len(rows)) + 0.5 * (s * s - q).sum(axis=1)
            e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[rows]) * weight[rows] / len(rows)
            ea = e[row] * a
            dw = np.bincount(back, ea, minlength=len(uniq)) + l2 * fm.w[uniq]
            dv = np.stack([np.bincount(back, ea * (s[row, f] - xv[:, f]), minlength=len(uniq)) for f in range(rank)], axis=1) + l2 * fm.v[uniq]
            dwd = x.T @ e + l2 * fm.w[first:]
            dvd = x.T @ (e[:, None] * s) - ((x * x).T @ e)[:, None] * vd + l2 * vd
            gw[uniq] += dw * dw
            gv[uniq] += dv * dv
            gw[first:] += dwd * dwd
            gv[first:] += dvd * dvd
            g0 += e.sum() ** 2
            fm.w[uniq] -= rate * dw / np.sqrt(gw[uniq])
            fm.v[uniq] -= rate * dv / np.sqrt(gv[uniq])
            fm.w[first:] -= rate * dwd / np.sqrt(gw[first:])
            fm.v[first:] -= rate * dvd / np.sqrt(gv[first:])
            fm.w0 -= rate * e.sum() / np.sqrt(g0)
    return fm


def _constant(share: float, n_dense: int) -> FactorisationMachine:
    share = min(max(share, 1e-6), 1 - 1e-6)
    size = (1 << BITS) + n_dense
    return FactorisationMachine(float(np.log(share / (1 - share))), np.zeros(size, np.float32),
                                np.zeros((size, RANK), np.float32), np.zeros(n_dense), np.ones(n_dense))


def _meta(b: pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.stack([np.nan_to_num(b.column(c).cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False))
                     for c in names], axis=1) if names else np.zeros((b.num_rows, 0))


def train(docs: DataFrame, labels: DataFrame, *, may_train: Column, id_col: str = "doc_id", text: str = "text",
          label: str = "quality", metadata: dict[str, Column] | None = None, max_rows: int = MAX_ROWS) -> FactorisationMachine:
    """Fits on at most ``max_rows`` labelled rows of each class among the labels for
    which ``may_train`` (an expression on ``labels``) holds. The sampled ids are broadcast
    (bounded by that parameter)."""
    metadata = metadata or {}
    lab = (labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & may_train)
           .groupBy(F.col(id_col).alias("_id")).agg((F.max(label) > 0).alias("_y")))
    n_dense = N_STATS + len(metadata)
    counts = {r[0]: r[1] for r in lab.groupBy("_y").count().collect()}
    if len(counts) < 2:
        return _constant(0.5 if not counts else float(next(iter(counts))), n_dense)
    picked = bounded_sample(lab.where("_y"), max_rows, "_id", total=counts[True]).unionByName(
        bounded_sample(lab.where("not _y"), max_rows, "_id", total=counts[False]))
    names = [f"_m{i}" for i in range(len(metadata))]
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"),
                       *(e.cast("double").alias(n) for n, e in zip(names, metadata.values()))).join(F.broadcast(picked), "_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [inputs(t) for t in utf8(b.column("_text"))]
            meta = _meta(b, names)
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), b.column("_y"), pa.array([w.tobytes() for w, _ in found], pa.binary()),
                 pa.array([np.concatenate([s, m]).tobytes() for (_, s), m in zip(found, meta)], pa.binary())], names=["_id", "_y", "w", "s"])
    schema = T.StructType([rows.schema["_id"], T.StructField("_y", T.BooleanType()),
                           T.StructField("w", T.BinaryType()), T.StructField("s", T.BinaryType())])
    got = {r["_id"]: r for r in rows.mapInArrow(run, schema).collect()}
    got = [got[i] for i in sorted(got)]
    y = np.array([float(r["_y"]) for r in got])
    if not len(y) or y.min() == y.max():
        return _constant(float(y.mean()) if len(y) else 0.5, n_dense)
    prior = counts[True] / sum(counts.values())
    weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    return fit([np.frombuffer(r["w"], np.int32) for r in got], np.stack([np.frombuffer(r["s"]) for r in got]), y, weight)


def score(docs: DataFrame, model: FactorisationMachine, *, text: str = "text",
          metadata: dict[str, Column] | None = None, out: str = "score") -> DataFrame:
    """Adds the score (0 to 1, higher: label 1 likelier) to every row."""
    metadata = metadata or {}
    keep = [c for c in docs.columns if c != out]
    names = [fresh(docs, f"_m{i}") for i in range(len(metadata))]
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            meta = _meta(b, names)
            z = np.empty(b.num_rows)
            for i, t in enumerate(utf8(b.column(text))):
                words, stats = inputs(t)
                z[i] = model.margin(words, np.concatenate([stats, meta[i]]))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(1 / (1 + np.exp(-np.clip(z, -35, 35))))],
                                             names=[*keep, out])
    return docs.select(*keep, *(e.cast("double").alias(n) for n, e in zip(names, metadata.values()))).mapInArrow(run, schema)
