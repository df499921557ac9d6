"""Outcome rows (45): a bad request never fails the job; it becomes a row with
``success = false`` and ``error``. Good rows carry ``success = true`` and a
``message``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_error(*checks: tuple[Column, Column | str]) -> Column:
    """The error text of the first failing check, else null.
    ``checks``: (failed_condition, error_text) pairs, tested in order."""
    expr = F.lit(None).cast("string")
    for cond, text in reversed(checks):
        t = F.lit(text) if isinstance(text, str) else text
        expr = F.when(F.coalesce(cond, F.lit(False)), t).otherwise(expr)
    return expr


def with_outcome(df: DataFrame, error: Column, message: str | Column | None = None) -> DataFrame:
    """Adds ``success``, ``error`` and, for good rows, ``message``."""
    out = df.withColumn("error", error).withColumn("success", F.col("error").isNull())
    if message is not None:
        m = F.lit(message) if isinstance(message, str) else message
        out = out.withColumn("message", F.when(F.col("success"), m))
    return out


def split_outcomes(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantine rows) by the ``success`` column."""
    return df.where(F.col("success")), df.where(~F.col("success"))


def outcome_json(df: DataFrame, *cols: str) -> Column:
    """The outcome as JSON text; null members are left out (``to_json`` of a
    struct drops null fields)."""
    return F.to_json(F.struct("success", *cols, "error"))


def with_total(df: DataFrame, name: str) -> DataFrame:
    """Adds the table's row count as column ``name``: an uncorrelated scalar
    subquery (computed once, then a constant), so no window gathers all rows
    in one task and no join is needed."""
    return df.withColumn(name, df.agg(F.count(F.lit(1))).scalar())
