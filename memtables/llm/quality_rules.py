"""Quality rules as a short-circuit cascade. DataFrame functions only.

:func:`base_stats` computes the statistics of every whole text. A
:class:`Rule` is a condition that rejects a row, and the work it takes (steps
per row, an expression). :func:`order_rules` estimates on a bounded
deterministic sample each rule's selectivity (share of rows it rejects) and cost (mean
work), and orders the rules by rejection per cost, best first (ties: by name).
:func:`cascade` tries the rules in that order and stops at the first that
rejects; a rule's expressions are evaluated only for rows that reach it. The order
changes the cost, and which rule is named, but never whether a row is kept.

Defined results: null and empty texts have no words and all counts 0; a null
condition doesn't reject; repeated rows get equal results; on an empty table the rules keep the
order of their names; extra columns are kept, columns named like a new one are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memtables.llm.common import SPACES, bounded_sample

WINDOW = 8
SAMPLE_ROWS = 1000
SYMBOLS = r"[#*$%&|<>]"
GAP = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column
    work: Column


def base_stats(docs: DataFrame, *, text: str = "text", window: int = WINDOW) -> DataFrame:
    """Adds ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines`` (with a word), ``n_dup_lines``, ``n_repeat_words``.

    Repeated windows are found inside the row: the hashes of all windows (of whole texts)
    are compared by a hash set; only rows with a repeat sort (hash, place) pairs, so the work is at
    most n log n in a text's words."""
    # the row travels as one struct, so its columns can't clash with those made here
    new = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    kept = [c for c in docs.columns if c not in new]
    keep = ["_row"]
    docs = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    t = F.col("_text")
    has_word = lambda x: F.btrim(x, F.lit(SPACES)) != ""
    d = docs.select(*keep, F.filter(F.split(t, GAP, -1), lambda w: w != "").alias("_words"),
                    F.filter(F.split(t, "\n", -1), has_word).alias("_lines"),
                    F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
    d = d.select(*keep, "n_symbols", F.size("_words").alias("_n"), F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
                 F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
                 F.size("_lines").cast("long").alias("n_lines"),
                 (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"))
    # _hashes is used twice, so the optimizer keeps it in a projection of its own
    grams = F.slice(F.transform("_hashes", lambda _, i: F.xxhash64(F.slice("_hashes", i + 1, window))), F.lit(1), F.greatest(F.size("_hashes") - (window - 1), F.lit(0)))
    d = d.select(*[c for c in d.columns if c != "_hashes"], grams.alias("_grams"))
    repeats = F.size(F.array_distinct("_grams")) < F.size("_grams")
    d = d.withColumn("_sorted", F.when(repeats, F.sort_array(F.transform("_grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    at = lambda j: F.try_element_at("_sorted", j)["h"]  # noqa: E731  from 1
    twice = F.filter("_sorted", lambda s, j: (F.when(j > 0, at(j)) == s["h"]) | (at(j + 2) == s["h"]))
    d = d.withColumn("_places", F.sort_array(F.transform(twice, lambda s: s["i"])))
    span = F.transform("_places", lambda p, j: F.least(F.coalesce(F.try_element_at("_places", j + 2) - p, F.lit(window)), F.lit(window)))
    covered = F.aggregate(span, F.lit(0).cast("long"), lambda a, s: a + s)
    return d.select("_row.*", F.col("_n").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                    F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def standard_rules(text: str = "text") -> list[Rule]:
    """Rules over a text and its base statistics. Work counts the characters looked at;
    a comparison of statistics that exist already counts 1."""
    t = F.coalesce(F.col(text), F.lit(""))
    chars, one = F.length(t).cast("double"), F.lit(1.0)
    words, symbols, lines = F.col("n_words"), F.col("n_symbols"), F.col("n_lines")
    return [
        Rule("symbols", 10 * symbols > 3 * words, one),
        Rule("duplicate_lines", (lines >= 5) & (100 * F.col("n_dup_lines") > 40 * lines), one),
        Rule("word_length", (F.col("word_chars") < 2 * words) | (F.col("word_chars") > 20 * words), one),
        Rule("upper_case", 2 * F.regexp_count(t, F.lit("[A-Z]")) > F.regexp_count(t, F.lit("[A-Za-z]")), 2 * chars),
        Rule("exclamation", 10 * F.regexp_count(t, F.lit("[!?]")) > 4 * words, chars),
        Rule("digits", 10 * F.regexp_count(t, F.lit("[0-9]")) > 3 * F.col("word_chars"), chars),
    ]


def order_rules(docs: DataFrame, rules: Sequence[Rule], *, id_col: str = "doc_id", text: str = "text",
                sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by estimated rejection per cost; one job over the statistics of a sample of texts."""
    if not rules:
        return []
    sample = base_stats(bounded_sample(docs.select(id_col, text), sample_rows, id_col), text=text)
    got = sample.agg(*(F.avg(F.coalesce(r.rejects, F.lit(False)).cast("double")).alias(f"r{i}") for i, r in enumerate(rules)),
                     *(F.avg(F.coalesce(r.work, F.lit(0.0))).alias(f"w{i}") for i, r in enumerate(rules))).first()
    worth = lambda i: (got[f"r{i}"] or 0.0) / max(got[f"w{i}"] or 0.0, 1e-9)
    return [r for _, _, r in sorted(((-worth(i), r.name, r) for i, r in enumerate(rules)), key=lambda x: x[:2])]


def cascade(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds ``rejected_by``: the first rule, in the given order, that rejects the row; else null."""
    verdict = F.lit(None).cast("string")
    for r in reversed(rules):
        verdict = F.when(r.rejects, F.lit(r.name)).otherwise(verdict)
    return df.withColumn("rejected_by", verdict)
