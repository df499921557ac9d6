"""Toxicity grades by cumulative-link ordinal regression.

One weight vector is shared by all ordered thresholds:
``P(grade <= k) = sigmoid(theta_k - w.x)`` with ``theta_0 < theta_1 < ...``.
The features are the presence of hashed words and hashed word beginnings (so
that inflected forms of a word share a feature). The output is the probability
that the grade is above 0 and the expected grade.

Labels. The model takes any integer grade 0..K. Tables that only say toxic 0/1
get grades by :func:`grades_from_binary`: a toxic text above the median density
of toxic words (those that the labels themselves single out) is grade 2, other
toxic texts are grade 1, the rest 0.

Training reads a bounded sample: at most ``max_rows`` labelled rows of each
class, those with the smallest hashes of their ids; ids that occur more than once in the
labels count once. The fitted model (under ``max_features`` weights) goes to
the scoring tasks with the function. Scoring reads every whole text.

Defined results: null and empty texts have no features and get the base rate;
repeated rows get equal scores; without labels, or with labels of one class
only, the expected grade is 0 for every row. Extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from memtables.llm.common import blocks, bounded_sample, utf8, word_hashes

BITS = 20
PREFIXES = (4, 5, 6)
MAX_ROWS = 3000
MAX_FEATURES = 4096


@dataclass
class OrdinalModel:
    """``hashes`` (sorted) and ``weights`` of the kept features; ordered ``thresholds``."""
    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    thresholds: np.ndarray = field(default_factory=lambda: np.full(2, 30.0))

    def margin(self, features: np.ndarray) -> float:
        if not len(self.hashes) or not len(features):
            return 0.0
        at = np.minimum(np.searchsorted(self.hashes, features), len(self.hashes) - 1)
        return float(self.weights[at[self.hashes[at] == features]].sum())

    def above(self, margin: float) -> np.ndarray:
        """P(grade > k) for each threshold k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - margin, -40, 40)))


def features(data: bytes) -> np.ndarray:
    """Distinct feature numbers of a whole text, in [0, 2^BITS) per kind of feature."""
    parts = []
    for block in blocks(data):
        for kind, h in enumerate(word_hashes(block, PREFIXES)):
            parts.append((h >> np.uint64(64 - BITS)).astype(np.int64) | (kind << BITS))
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)


def feature_rows(docs: DataFrame, text: str, *keep: str) -> DataFrame:
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("features", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [features(t).astype(np.int32).tobytes() for t in utf8(b.column(text))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(found, pa.binary())],
                                             names=[*keep, "features"])
    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def _select(rows: list[np.ndarray], toxic: np.ndarray, most: int) -> np.ndarray:
    """The features whose presence differs most between the classes (signed root
    of the chi-square statistic), seen in at least three rows; sorted."""
    size = (len(PREFIXES) + 1) << BITS
    n1, n0 = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    seen = [np.bincount(np.concatenate([np.zeros(0, np.int32), *(r for r, t in zip(rows, toxic) if t == which)]),
                        minlength=size) for which in (True, False)]
    often = np.flatnonzero(seen[0] + seen[1] >= 3)
    with_1, with_0 = seen[0][often], seen[1][often]
    p = (with_1 + with_0) / (n1 + n0)
    score = np.abs(with_1 / n1 - with_0 / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0) + 1e-12)
    best = np.argsort(-score, kind="stable")[:most]
    return np.sort(often[best[score[best] > 2.5]])


def grades_from_binary(rows: list[np.ndarray], toxic: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Grades 0, 1, 2 (see the module)."""
    size = (len(PREFIXES) + 1) << BITS
    kept = _select(rows, toxic, 512)
    mark = np.zeros(size, bool)
    mark[kept] = True
    clean = np.bincount(np.concatenate([np.zeros(0, np.int32), *(r for r, t in zip(rows, toxic) if not t)]), minlength=size)
    mark[clean > 0.01 * max(1, (~toxic).sum())] = False
    density = np.array([mark[r].sum() for r in rows]) / np.maximum(lengths, 1)
    cut = np.median(density[toxic]) if toxic.any() else 0.0
    return np.where(toxic, 1 + (density > cut), 0)


def fit(rows: list[np.ndarray], grade: np.ndarray, prior: float, *, max_features: int = MAX_FEATURES,
        steps: int = 300, l2: float = 0.02, l1: float = 0.002) -> OrdinalModel:
    """Full-batch Adam on the log-likelihood of the grades, with an L1 and L2
    penalty on the shared weights. ``prior``: share of toxic rows before the
    classes were sampled; rows are weighted back to it, the square root of the way."""
    top = int(grade.max()) if len(grade) else 0
    if top < 1 or not (grade == 0).any():
        return OrdinalModel()
    toxic = grade > 0
    kept = _select(rows, toxic, max_features)
    at, where = [], []
    for i, r in enumerate(rows):
        p = np.minimum(np.searchsorted(kept, r), max(0, len(kept) - 1))
        hit = p[kept[p] == r] if len(kept) else p[:0]
        at.append(hit)
        where.append(np.full(len(hit), i))
    col, row = np.concatenate(at).astype(np.int64), np.concatenate(where).astype(np.int64)
    n, share = len(rows), toxic.mean()
    weight = np.where(toxic, np.sqrt(prior / share), np.sqrt((1 - prior) / (1 - share)))
    weight = weight / weight.sum()
    # theta_0, then positive gaps as exponentials keep the thresholds in order
    par = np.concatenate([np.zeros(len(kept)), [2.0], np.zeros(top - 1)])
    m, v = np.zeros_like(par), np.zeros_like(par)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    k = len(kept)
    for step in range(1, steps + 1):
        theta = par[k] + np.concatenate([[0], np.cumsum(np.exp(par[k + 1:]))])
        z = np.bincount(row, par[:k][col], minlength=n)
        edges = np.concatenate([np.zeros((n, 1)), sig(theta[None, :] - z[:, None]), np.ones((n, 1))], axis=1)
        slope = edges * (1 - edges)
        lo, hi = edges[np.arange(n), grade], edges[np.arange(n), grade + 1]
        p = np.maximum(hi - lo, 1e-12)
        d_hi, d_lo = slope[np.arange(n), grade + 1] / p * weight, slope[np.arange(n), grade] / p * weight
        g = np.empty_like(par)
        g[:k] = np.bincount(col, (d_hi - d_lo)[row], minlength=k) + 1e-3 * l2 * par[:k] + 1e-3 * l1 * np.sign(par[:k])
        g_theta = np.bincount(grade, -d_hi, minlength=top + 1)[:top] + np.bincount(grade, d_lo, minlength=top + 1)[1:]
        g[k] = g_theta.sum()
        g[k + 1:] = np.cumsum(g_theta[::-1])[::-1][1:] * np.exp(par[k + 1:])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        par = par - 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    theta = par[k] + np.concatenate([[0], np.cumsum(np.exp(par[k + 1:]))])
    return OrdinalModel(kept.astype(np.int64), par[:k], theta)


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text",
          toxic: str = "toxic", max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES) -> OrdinalModel:
    """Fits on at most ``max_rows`` labelled rows of each class. The sampled ids (bounded
    by that parameter) are broadcast, so the texts aren't shuffled."""
    lab = (labels.where(F.col(id_col).isNotNull() & F.col(toxic).isNotNull())
           .groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(toxic) > 0).alias("_toxic")))
    counts = {r[0]: r[1] for r in lab.groupBy("_toxic").count().collect()}
    if len(counts) < 2:
        return OrdinalModel()
    picked = bounded_sample(lab.where("_toxic"), max_rows, "_id", total=counts[True]).unionByName(
        bounded_sample(lab.where("not _toxic"), max_rows, "_id", total=counts[False]))
    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
            .join(F.broadcast(picked), "_id"))
    found = {r["_id"]: (r["_toxic"], np.frombuffer(r["features"], np.int32))
             for r in feature_rows(rows, "_text", "_id", "_toxic").collect()}
    if not found:
        return OrdinalModel()
    ids = sorted(found)
    is_toxic = np.array([found[i][0] for i in ids])
    feats = [found[i][1] for i in ids]
    if is_toxic.all() or not is_toxic.any():
        return OrdinalModel()
    grade = grades_from_binary(feats, is_toxic, np.array([len(f) for f in feats]))
    return fit(feats, grade, counts[True] / sum(counts.values()), max_features=max_features)


def score(docs: DataFrame, model: OrdinalModel, *, text: str = "text") -> DataFrame:
    """Adds ``p_toxic`` (the grade is above 0), ``expected_severity`` (the mean
    grade) and ``grade`` (the likeliest one) to every row."""
    added = ["p_toxic", "expected_severity", "grade"]
    keep = [c for c in docs.columns if c not in added]
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("p_toxic", T.DoubleType()),
                           T.StructField("expected_severity", T.DoubleType()), T.StructField("grade", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = np.array([model.above(model.margin(features(t))) for t in utf8(b.column(text))])
            p = p.reshape(b.num_rows, len(model.thresholds))
            shares = -np.diff(np.concatenate([np.ones((len(p), 1)), p, np.zeros((len(p), 1))], axis=1), axis=1)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in keep), pa.array(p[:, 0]), pa.array(p.sum(axis=1)),
                 pa.array(shares.argmax(axis=1).astype(np.int32))], names=[*keep, *added])
    return docs.select(*keep).mapInArrow(run, schema)
