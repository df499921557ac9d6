"""A training corpus from ``documents``: toxic documents go, repeated lines go, one document of each
near-duplicate group stays, sources are mixed to their weights, and the mix is packed.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read again
as the next one's ``docs``. All but the last return the columns of ``docs``. Columns beyond
those of ``documents`` are kept; null texts stay null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memtables.llm import line_dedup, mixing, queries, simhash, toxicity
from memtables.llm.common import table
from memtables.session import materialized, ship_package


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 1: documents whose probability of a grade above 0 reaches ``queries.TOXIC_FROM`` go."""
    ship_package(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select(F.struct(*docs.columns).alias("d"), F.col("text").alias("_text")), model, text="_text")
    return scored.where(F.col("p_toxic") < queries.TOXIC_FROM).select("d.*")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 2: lines found in many documents stay in the document with the largest id."""
    ship_package(spark)
    packed = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"), F.struct(*(c for c in docs.columns if c != "text")).alias("d"))
    state = line_dedup.insert(packed, id_col="_id", text="_text")
    kept = line_dedup.drop_lines(packed, state, id_col="_id", text="_text")
    return kept.select(*(F.col("_text").alias(c) if c == "text" else F.col("d")[c].alias(c) for c in docs.columns))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 3: of each group of near duplicates the document with the smallest id stays (null ids
    come last); of several rows with that id, the first by text. Groups are of fingerprints, not of
    ids: rows that share an id but not a group each stand for themselves."""
    ship_package(spark)
    return simhash.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 4: each document as often as the mix takes it."""
    ship_package(spark)
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 5: windows of 1024 tokens; one row per piece."""
    ship_package(spark)
    return queries.packed(docs)


STAGES = [("toxicity", clean_of_toxicity), ("line_dedup", without_repeated_lines), ("simhash_near_dedup", one_of_each_group),
          ("mixing", mixed), ("packing", packed)]

#: SQL can express neither the trained filter nor the fingerprints' components.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
