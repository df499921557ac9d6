"""Mixing sources to target weights by systematic sampling.

Targets. Sources in code point order (null last) weigh 5, 2, 1, repeating (or
any weights), and share ``share`` times the size of all documents. A target
stops at ``most`` times its source's size; the excess goes to the others by
weight until none is above. In closed form: with the sources sorted by (cap /
weight), the ones below the water level are capped, the rest get weight times level.

Copies. Every document of a source expects r = target / source size copies.
The documents stand in a line by size (smallest first), with r as each one's
length; one random offset u per source (from the seed) shifts the line, and a document is
emitted once per integer boundary crossed:
``floor(i*r + u) - floor((i-1)*r + u)`` copies for the i-th document. As the line
is in order of size, the words taken stay within about one large document of the target.

The place i in the line is a prefix sum in two levels: documents are counted by
cell (source, size, part), cells are summed up per source, and only a cell's own
rows are ranked together. Documents of one source and size are cut into
parts of about ``CELL`` rows by the hash of the document's id (null ids: of the whole row), so
no cell grows with a hot source or size, whatever the ids; a source has a cell for each size and
each ``CELL`` rows of one.

Defined results: a null text has size 0; documents of size 0 have copies like
others but take no words; an empty source (all sizes 0) has target 0 and no
copies; ids may be of any type; rows of one part stand in order of id (nulls first), then of the hash
of the whole row; equal rows stand next to each other, and each has its own place
and copies; an empty table gives no rows. Extra columns are kept by :func:`mix`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from memtables.llm.common import n_words
from memtables.session import materialized

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
CELL = 1000
SEED = "mix-1"


def offset(source: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) for each source, from the seed."""
    tagged = F.concat(F.lit(seed + "|"), F.coalesce(F.concat(F.lit("s"), source), F.lit("null")))
    return F.conv(F.substring(F.md5(F.encode(tagged, "UTF-8")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def targets(sizes: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``sizes``: one row per ``source`` with ``source_size``. Adds ``weight`` and ``target``.
    Windows over all sources hold one row per source."""
    line = Window.orderBy(F.col("source").asc_nulls_last())
    w = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(line) - 1, F.lit(len(weights))) + 1).cast("int")))
    # most is a small number and sizes are whole, so these products and sums are exact
    w = w.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    every = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    upto = every.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = (w.withColumn("capped", F.coalesce(F.sum("cap").over(upto), F.lit(0.0)))
         .withColumn("heavy", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(upto), F.lit(0)))
         .withColumn("all", F.sum("source_size").over(whole)))
    # the water level if exactly the sources before this one are capped; the first that it doesn't drown sets it
    w = w.withColumn("level", (F.col("all") * F.lit(float(share)) - F.col("capped")) / F.col("heavy"))
    w = w.withColumn("water", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(whole)["level"])
    return w.select("source", "source_size", "weight",
                    F.when(F.col("water").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("water") * F.col("weight"))).alias("target"))


def _drawn(docs: DataFrame, id_col: str, text: str, source: str, seed: str, weights, share: float, most: float) -> DataFrame:
    """One row per distinct row of ``docs``: ``id``, ``tie`` (the hash of the whole row), ``size``,
    ``source_size``, ``target``, ``n`` (how many rows are equal to it), ``before`` (the length of the line
    in front of them), ``r`` and ``u``. Texts are read once; ids and numbers are
    written once and shuffled. Equal rows are counted by partial sums before any ranking."""
    rows = materialized(docs.select(F.col(id_col).alias("id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"),
                                    row_hash(docs).alias("tie")))
    by_size = rows.groupBy("source", "size").agg(F.count("*").alias("n"))
    parts = by_size.select(F.col("source").alias("c_source"), F.col("size").alias("c_size"), F.ceil(F.col("n") / F.lit(CELL)).alias("parts"))
    same = F.col("source").eqNullSafe(F.col("c_source")) & (F.col("size") == F.col("c_size"))
    distinct = rows.groupBy("id", "source", "size", "tie").agg(F.count("*").alias("n"))
    distinct = distinct.join(parts, same).drop("c_source", "c_size").withColumn(
        "part", F.pmod(F.coalesce(id_hash(F.col("id")), F.col("tie")), F.col("parts"))).drop("parts")
    line = Window.partitionBy("source").orderBy("size", "part").rowsBetween(Window.unboundedPreceding, -1)
    cells = (distinct.groupBy("source", "size", "part").agg(F.sum("n").alias("cell_n"))
             .withColumn("cell_before", F.coalesce(F.sum("cell_n").over(line), F.lit(0))))
    per_source = by_size.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    goal = targets(per_source, weights=weights, share=share, most=most).withColumn("u", offset(F.col("source"), seed))
    cells = cells.join(goal.withColumnRenamed("source", "g_source"), F.col("source").eqNullSafe(F.col("g_source"))).select(
        F.col("source").alias("c_source"), F.col("size").alias("c_size"), F.col("part").alias("c_part"), "cell_before", "source_size", "target", "u")
    inside = Window.partitionBy("source", "size", "part").orderBy("id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    ranked = distinct.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    ranked = ranked.join(cells, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("size") == F.col("c_size")) & (F.col("part") == F.col("c_part")))
    return ranked.select("id", "tie", "size", "source_size", "target", "n", (F.col("cell_before") + F.col("inside")).alias("before"), "u",
                         F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("r"))


def id_hash(value: Column) -> Column:
    """32 bits of an id's MD5: ids of any stride, and text, spread evenly. Null for null."""
    return F.conv(F.substring(F.md5(F.encode(value.cast("string"), "UTF-8")), 1, 8), 16, 10).cast("long")


def row_hash(docs: DataFrame) -> Column:
    """The hash of a whole row (columns that Spark can't hash are left out)."""
    hard = ("map", "variant")
    return F.xxhash64(*(F.col(f"`{c}`") for c, kind in docs.dtypes if not any(k in kind for k in hard)))


def _crossed(first: Column, last: Column) -> Column:
    """Integer boundaries crossed by places ``first`` + 1 to ``last`` of the line."""
    return (F.floor(last * F.col("r") + F.col("u")) - F.floor(first * F.col("r") + F.col("u"))).cast("long")


def _repeated(df: DataFrame, times: str, *keys: str) -> DataFrame:
    """Each row ``times`` times, with ``turn`` from 0. Rows repeated over 1000 times are dealt out
    in lots of 1000 before they are written out."""
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    few = df.where(F.col(times).between(1, 1000)).withColumn("turn", each(F.col(times)))
    many = df.where(F.col(times) > 1000).withColumn("lot", each(F.ceil(F.col(times) / 1000)))
    many = many.repartition(*keys, "lot").withColumn("turn", each(F.least(F.lit(1000).cast("long"), F.col(times) - 1000 * F.col("lot"))))
    return few.unionByName(many.withColumn("turn", F.col("turn") + 1000 * F.col("lot")).drop("lot"))


def copies(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", source: str = "source", seed: str = SEED,
           weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``id_col``, ``size``, ``source_size``, ``target`` and ``copies`` of every row."""
    d = _repeated(_drawn(docs, id_col, text, source, seed, weights, share, most), "n", "id", "tie")
    i = F.col("before") + F.col("turn")
    return d.select(F.col("id").alias(id_col), "size", "source_size", "target",
                    F.least(_crossed(i, i + 1), F.ceil(F.lit(float(most)))).cast("long").alias("copies"))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", source: str = "source", seed: str = SEED,
        weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The rows of ``docs``, each as often as it has copies. Only distinct rows with a
    copy are multiplied; the texts are shuffled once."""
    drawn = _drawn(docs, id_col, text, source, seed, weights, share, most).select(
        F.col("id").alias("k_id"), F.col("tie").alias("k_tie"), F.col("n").alias("k_n"),
        _crossed(F.col("before"), F.col("before") + F.col("n")).alias("k_copies")).where("k_copies > 0")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("d"), F.col(id_col).alias("id"), row_hash(docs).alias("tie"))
    rows = rows.join(drawn.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("k_id")) & (F.col("tie") == F.col("k_tie")))
    rows = rows.select("d", "id", "tie", F.col("k_n").alias("n"), F.col("k_copies").alias("copies"))
    alone = rows.where("n = 1")
    equal = rows.where("n > 1").groupBy("id", "tie").agg(F.first("d").alias("d"), F.first("n").alias("n"), F.first("copies").alias("copies"))
    return _repeated(alone.unionByName(equal, allowMissingColumns=False), "copies", "id", "tie").select("d.*")
