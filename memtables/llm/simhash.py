"""Near duplicates by SimHash fingerprints and generalised pigeonhole search.

Fingerprint. Texts are lower-cased (A-Z) and split at ASCII white space; every
run of ``shingle`` words (fewer words: all of them), joined by a space, gives
its XXH64 (seed 42). Bit i of the fingerprint is set if bit i is set in over
half of the hashes. Texts without words have fingerprint zero.

Search for all fingerprints within ``distance`` bits. The 64 bits are grouped
into m parts, correlated bits together. Two fingerprints within distance t
agree to within T_i bits in some part i, if the thresholds T_i (-1: the part is
not probed) sum to t - m + 1. The thresholds are unequal: dynamic programming
picks, over m and T, the least expected cost of probes and of candidates. The
costs come from the distances in a bounded sample of fingerprints; they change
the plan, never the result. A part with threshold T is probed by all its values
with T bits masked; fingerprints with equal masked values are candidates, and
each candidate is verified on all 64 bits.

Buckets of over ``bucket`` fingerprints are split exactly: the bits that the
bucket leaves open are cut into six groups, and a pair within two bits agrees on all
but two of the groups, so it meets again in one of 15 finer buckets. Those hold
at most 2^(bits of two groups) distinct fingerprints, whatever the data.

Only distinct fingerprints take part, each for all its documents. A bucket
returns a spanning forest of its links, not all pairs. Components come from
:mod:`memtables.llm.graph`.

Defined results: null and empty texts are linked like any other; repeated rows
share a fingerprint and a component; documents with a null id belong to their fingerprint's
component, link others through it and never name it (null if no document there has an id); an empty
table gives no rows; extra columns are not read by :func:`near_duplicates` and kept by :func:`one_of_each`.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from memtables.llm.common import bounded_sample, utf8
from memtables.llm.graph import components
from memtables.session import materialized

BITS = 64
SHINGLE = 3
DISTANCE = 2
SAMPLE = 2048
BUCKET = 2000
#: Relative cost of sending one probe and of verifying one candidate pair.
PROBE_COST, CANDIDATE_COST = 1.0, 0.02


# -- fingerprints --------------------------------------------------------------

def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    from xxhash import xxh64_intdigest
    words = data.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxh64_intdigest(b" ".join(words), 42)
    joined = b" ".join(words)
    end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    start = np.concatenate([[0], end[:-1] + 1])
    n = len(words) - shingle + 1
    hashes = np.fromiter((xxh64_intdigest(joined[a:b], 42) for a, b in zip(start[:n].tolist(), end[shingle - 1:].tolist())), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``id_col`` and ``fp`` (the 64 bits as a signed long) of every row."""
    schema = T.StructType([docs.schema[id_col], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in utf8(b.column(text))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(id_col), pa.array(fp)], names=[id_col, "fp"])
    return docs.select(id_col, text).mapInArrow(run, schema)


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# -- the plan of the search ------------------------------------------------------

def group_bits(sample: np.ndarray, m: int) -> list[list[int]]:
    """m parts of nearly equal size; each is grown from a free bit by the free bits
    most correlated with it."""
    on = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(float)
    on -= on.mean(axis=0)
    norm = np.sqrt((on * on).sum(axis=0)) + 1e-9
    near = np.abs(on.T @ on) / norm[:, None] / norm[None, :]
    free, parts = list(range(BITS)), []
    for i in range(m):
        size = (BITS - sum(map(len, parts))) // (m - i)
        seed = max(free, key=lambda b: (near[b, free].sum(), -b))
        part = [seed]
        free.remove(seed)
        while len(part) < size:
            best = max(free, key=lambda b: (near[b, part].sum(), -b))
            part.append(best)
            free.remove(best)
        parts.append(sorted(part))
    return parts


def _mask(bits) -> int:
    return sum(1 << b for b in bits)


def allocate(cost: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """Thresholds T_i that sum to ``total`` at least cost; dynamic programming over the parts."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in cost:
        reached: dict[int, tuple[float, list[int]]] = {}
        for have, (spent, chosen) in best.items():
            for t, c in part.items():
                if have + t not in reached or spent + c < reached[have + t][0]:
                    reached[have + t] = (spent + c, [*chosen, t])
        best = reached
    return best[total]


def plan(sample: np.ndarray, n: int, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the probed parts, for ``n`` fingerprints like the sample."""
    choices = []
    x = sample[:, None] ^ sample[None, :]
    upper = np.triu_indices(len(sample), 1)
    scale = (n / max(1, len(sample))) ** 2
    for m in range(1, min(8, 2 * (distance + 2)) + 1):
        parts = group_bits(sample, m)
        cost = []
        for bits in parts:
            w, apart = len(bits), np.bitwise_count(x & np.uint64(_mask(bits)))[upper]
            by = {-1: 0.0}
            balls, probes = 0, 0
            for t in range(distance + 1):
                ways = 1
                for j in range(t):
                    ways = ways * (w - j) // (j + 1)
                balls, probes = balls + ways, ways
                pairs = max(scale * float((apart <= t).sum()), n * n / 2 * min(1.0, balls / 2.0 ** w))
                by[t] = PROBE_COST * n * probes + CANDIDATE_COST * pairs
            cost.append(by)
        if -m <= distance - m + 1 <= distance * m:
            spent, chosen = allocate(cost, distance - m + 1)
            choices.append((spent, [(b, t) for b, t in zip(parts, chosen) if t >= 0]))
    return min(choices, key=lambda c: c[0])[1]


# -- links -----------------------------------------------------------------------

def _signed(v: int) -> int:
    return v - (1 << 64) if v >= 1 << 63 else v


def probes(parts: list[tuple[list[int], int]]) -> list[int]:
    """The masks of all probes; a pair within the distance agrees under at least one."""
    return [_mask(set(bits) - set(gone)) for bits, t in parts for gone in combinations(bits, t)]


def splits(mask: int, distance: int = DISTANCE, groups: int = 6) -> list[int]:
    """Finer masks for a hot bucket: the bits that ``mask`` leaves open in groups, all but
    ``distance`` of which must agree."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    cut = [free[i::groups] for i in range(groups)]
    return [mask | _mask(b for i, g in enumerate(cut) if i not in gone for b in g)
            for gone in combinations(range(groups), min(distance, groups))]


def forest(fp: np.ndarray, distance: int, free: int) -> tuple[np.ndarray, np.ndarray]:
    """(members, roots) of a spanning forest over the distinct fingerprints within
    ``distance`` of each other; only the bits in ``free`` can differ."""
    n = len(fp)
    if n <= BUCKET:
        i, j = [], []
        for at in range(0, n, 512):
            a, b = np.nonzero(np.bitwise_count(fp[at:at + 512, None] ^ fp[None, :]) <= distance)
            up = a + at < b
            i.append(a[up] + at)
            j.append(b[up])
        i, j = np.concatenate(i), np.concatenate(j)
    else:
        order = np.argsort(fp)
        ranked, i, j = fp[order], [], []
        bits = [b for b in range(BITS) if free >> b & 1]
        for t in range(1, distance + 1):
            for flip in combinations(bits, t):
                other = ranked ^ np.uint64(_mask(flip))
                at = np.minimum(np.searchsorted(ranked, other), n - 1)
                hit = np.flatnonzero((ranked[at] == other) & (other > ranked))
                i.append(order[hit])
                j.append(order[at[hit]])
        i, j = np.concatenate(i), np.concatenate(j)
    low = np.arange(n)
    while len(i):
        now = low.copy()
        np.minimum.at(now, i, low[j])
        np.minimum.at(now, j, low[i])
        now = now[now]
        if (now == low).all():
            break
        low = now
    member = np.flatnonzero(low != np.arange(n))
    return member, low[member]


def links(reps: DataFrame, *, distance: int = DISTANCE, sample_rows: int = SAMPLE, bucket: int = BUCKET) -> DataFrame:
    """``reps``: distinct ``fp`` with ``rep`` (a long). Returns links ``a``, ``b`` between reps
    that connect all fingerprints within ``distance`` bits."""
    n = reps.count()
    sample = np.array([r["fp"] for r in bounded_sample(reps, sample_rows, "fp", total=n).select("fp").collect()], np.int64).view(np.uint64)
    masks = probes(plan(sample, n, distance)) if n > 1 else []
    if not masks:
        return reps.select(F.col("rep").alias("a"), F.col("rep").alias("b")).limit(0)
    finer = [splits(m, distance) for m in masks]

    value = lambda k, m: F.struct(F.lit(k).alias("probe"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("value"))
    post = reps.select("fp", "rep", F.explode(F.array(*(value(k, m) for k, m in enumerate(masks)))).alias("s")) \
        .select("s.probe", "s.value", "fp", "rep")
    full = materialized(post.groupBy("probe", "value").agg(F.count("*").alias("n")).where("n > 1"))
    post = post.join(full, ["probe", "value"])
    even = post.where(F.col("n") <= bucket).select("probe", F.lit(-1).alias("split"), "value", "fp", "rep")
    n_split = len(finer[0])
    fine = F.array(*(F.array(*(F.lit(_signed(f[s])) for f in finer)) for s in range(n_split)))
    hot = (post.where(F.col("n") > bucket)
           .select("probe", "fp", "rep", F.posexplode(fine).alias("split", "by_probe"))
           .select("probe", "split", F.col("fp").bitwiseAND(F.element_at("by_probe", F.col("probe") + 1)).alias("value"), "fp", "rep"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["probe", "split", "value", "fp", "rep"]
        held = [np.zeros(0, np.int64) for _ in names]

        def done(c: list[np.ndarray]):
            """The links of whole buckets (rows sorted by bucket)."""
            probe, split, val, fp, rep = c
            edge = np.flatnonzero((probe[1:] != probe[:-1]) | (split[1:] != split[:-1]) | (val[1:] != val[:-1])) + 1
            a, b = [], []
            for s, e in zip(np.concatenate([[0], edge]).tolist(), np.concatenate([edge, [len(probe)]]).tolist()):
                if e - s < 2:
                    continue
                mask = masks[probe[s]] if split[s] < 0 else finer[probe[s]][split[s]]
                if e - s == 2:
                    if (int(fp[s] ^ fp[s + 1]) & (2 ** 64 - 1)).bit_count() <= distance:
                        a.append(rep[s:s + 1])
                        b.append(rep[s + 1:s + 2])
                    continue
                i, j = forest(fp[s:e].view(np.uint64), distance, ~mask & (2 ** 64 - 1))
                a.append(rep[s:e][i])
                b.append(rep[s:e][j])
            a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (a, b))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
        for batch in batches:
            new = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names]
            held = [np.concatenate([h, x]) for h, x in zip(held, new)]
            same = (held[0] == held[0][-1]) & (held[1] == held[1][-1]) & (held[2] == held[2][-1]) if len(held[0]) else []
            cut = int(np.argmax(same)) if len(held[0]) else 0
            if cut:
                yield done([h[:cut].copy() for h in held])
                held = [h[cut:].copy() for h in held]
        if len(held[0]):
            yield done(held)
    keyed = even.unionByName(hot)
    keyed = keyed.repartition("probe", "split", "value").sortWithinPartitions("probe", "split", "value")
    return keyed.mapInArrow(run, "a long, b long")


def groups(fps: DataFrame, *, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Every distinct ``fp`` and its ``group``, the smallest fingerprint reachable over links
    of at most ``distance`` bits, whatever the ids are."""
    reps = materialized(fps.select("fp", F.col("fp").alias("rep")).distinct())
    found = components(links(reps, distance=distance, bucket=bucket))
    return reps.join(found, reps["rep"] == found["node"], "left").select("fp", F.coalesce("component", "rep").alias("group"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """``id_col``, ``fp`` and ``component_id`` (the smallest id reachable over links of at
    most ``distance`` bits, links through rows without an id included) of every row. Ids may be of any
    type that has an order."""
    fps = materialized(fingerprints(docs, id_col=id_col, text=text, shingle=shingle))
    found = materialized(groups(fps.select("fp"), distance=distance, bucket=bucket))
    lowest = fps.groupBy("fp").agg(F.min(id_col).alias("low")).join(found, "fp")
    names = lowest.groupBy(F.col("group").alias("named")).agg(F.min("low").alias("component_id"))
    by_fp = found.join(names, F.col("group") == F.col("named")).select(F.col("fp").alias("found_fp"), "component_id")
    return fps.join(by_fp, F.col("fp") == F.col("found_fp")).select(id_col, "fp", "component_id")


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group the row with the smallest id (null ids
    last), of several rows with that id the first by text (null first). Groups are of fingerprints, not of ids:
    rows that share an id but not a group each stand for themselves. Rows are carried as one struct, so
    columns of any name and type are kept; of rows that agree in id, text and hash any one stays."""
    tie = F.coalesce(F.md5(text), F.lit(""))
    keyed = docs.select(F.struct(F.col(id_col).alias("id"), tie.alias("tie")).alias("key"), F.col(text).alias("text"))
    keys = materialized(fingerprints(keyed, id_col="key", text="text", shingle=shingle).select("key.id", "key.tie", "fp"))
    found = materialized(groups(keys.select("fp"), distance=distance, bucket=bucket))
    # the best row of each fingerprint, then of each group; n: rows with its id, of which one stays
    best = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "n", "tie")).alias("b")
    by_fp = keys.groupBy("fp", "id").agg(F.count("*").alias("n"), F.min("tie").alias("tie")).groupBy("fp").agg(best)
    by_group = by_fp.join(found, "fp").groupBy("group", F.col("b.id").alias("id")).agg(F.sum("b.n").alias("n"), F.min("b.tie").alias("tie"))
    least = materialized(by_group.groupBy("group").agg(best).select("group", "b.id", "b.n", "b.tie"))
    several = found.join(least.where("n > 1").select(F.col("group").alias("of"), F.col("id").alias("best_id")), F.col("group") == F.col("of"))
    several = several.select(F.col("fp").alias("best_fp"), "of", "best_id")
    several = keys.join(several, (F.col("fp") == F.col("best_fp")) & F.col("id").eqNullSafe(F.col("best_id"))).select("id", "tie", "of").distinct()
    stay = least.where("n = 1").select("id", "tie", F.col("group").alias("of"), F.lit(True).alias("one")).unionByName(
        several.withColumn("one", F.lit(False)))
    stay = materialized(stay.select(F.col("id").alias("stay_id"), F.col("tie").alias("stay_tie"), "of", "one"))
    # both branches below read the same columns, so that the rows are shuffled once
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("d"), F.col(id_col).alias("id"), tie.alias("tie"))
    whole = F.xxhash64(*(F.col("d")[c] for c, kind in docs.dtypes if "map" not in kind and "variant" not in kind))
    rows = rows.join(stay.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("stay_id")) & (F.col("tie") == F.col("stay_tie")))
    again = rows.where("not one").groupBy("of").agg(F.min_by("d", F.struct(F.col("d")[text], whole)).alias("d"))
    return rows.where("one").select("d").unionByName(again.select("d")).select("d.*")
