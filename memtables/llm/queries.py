"""The registered queries of this subpackage: each applies its operator, with production
parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memtables.llm import (ann, bitplanes, chat_format, line_dedup, mixing, packing, pii, quality, quality_rules, runs, sentence_pieces,
                           simhash, toxicity)
from memtables.llm.common import WORD, table
from memtables.session import ship_package

#: A document is toxic if P(grade > 0) reaches this.
TOXIC_FROM = 0.4
#: A document's quality is predicted 1 from this score on.
GOOD_FROM = 0.3

def metadata():
    """Metadata inputs of the quality score."""
    return {"n_chars": F.log1p(F.greatest(F.coalesce(F.col("n_chars"), F.lit(0)), F.lit(0)).cast("double")) / 10}


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, p_toxic, expected_severity, grade, toxic of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", "p_toxic", "expected_severity", "grade",
                                              (F.col("p_toxic") >= TOXIC_FROM).alias("toxic"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    model = quality.train(docs, table(spark, sf_dir, "labels"), may_train=~held_out, metadata=metadata())
    return quality.score(docs, model, metadata=metadata()).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= GOOD_FROM, 1).otherwise(0).cast("int").alias("predicted"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    state = line_dedup.insert(docs)
    return line_dedup.drop_lines(docs, state).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("kept_sha256"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality_rules.order_rules(docs, quality_rules.standard_rules())
    failed = quality_rules.base_failed()
    return quality_rules.cascade(quality_rules.base_stats(docs), rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & F.col("rejected_by").isNull()).alias("kept"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    import public_tokenizers
    pieces = packing.pack(docs, tokenizer=public_tokenizers.path("byte_bpe_50k.json"), ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, whose texts hold control strings."""
    c = table(spark, sf_dir, "conversations")
    hard = spark.range(2).select(
        F.lit(-1).cast(c.schema["conv_id"].dataType).alias("conv_id"), F.col("id").cast(c.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    out = chat_format.format_conversations(c.select("conv_id", "turn", "role", "text").unionByName(hard))
    out = out.select("conv_id", "valid", "error_turn", "formatted", chat_format.read_back(F.col("formatted")).alias("turns"),
                     chat_format.loss_text(F.col("segments")).alias("loss"))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    sha = lambda x: F.sha2(F.encode(x, "UTF-8"), 256)
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), sha(spoken).alias("turns_sha256"),
                      F.length("loss").cast("long").alias("loss_chars"), sha(F.col("loss")).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"), "valid", F.col("error_turn").cast("long").alias("error_turn"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.copies(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", count("email"), count("ip"), count("card"), count("phone"),
                        F.sha2(F.encode(pii.joined(F.col("base")), "UTF-8"), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, where one document in ten (crc32 of the id divisible by 10) goes on from word
    a with its words a .. a + p - 1 again and again."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    docs = docs.select("doc_id", "text", g.alias("g"),
                       F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("w"))
    docs = docs.select("doc_id", "text", "g", "w", F.size("w").alias("n"))
    a = F.col("g") % F.col("n")
    docs = docs.select("doc_id", "text", "w", "n", F.when(F.col("n") > 0, a).cast("int").alias("a"), "g")
    p = (F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)) + 1).cast("int")
    docs = docs.select("doc_id", "text", "w", "n", "a", p.alias("p"))
    rest = F.col("n") - F.col("a")
    again = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int")))
    made = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(again, F.lit(1), rest)), " ")
    return docs.select("doc_id", F.when(F.col("a").isNotNull(), made).otherwise(F.col("text")).alias("text"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_periods(table(spark, sf_dir, "documents"))
    found = docs.select("doc_id", runs.periodic_runs(F.col("text")).alias("r")).select("doc_id", "r.runs", "r.collapsed")
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    out = found.select("doc_id", "collapsed", F.size("runs").cast("long").alias("n_runs"), longest.alias("m"),
                       F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("").alias("lines"))
    sha = lambda c: F.sha2(F.encode(F.col(c), "UTF-8"), 256)
    length, period = F.col("m.length"), -F.col("m.p")
    return out.select("doc_id", "n_runs", (-F.col("m.s")).alias("start"), length.alias("length"), period.alias("period"),
                      F.floor(1000 * length / period).alias("exponent_milli"), sha("lines").alias("runs_sha256"), sha("collapsed").alias("collapsed_sha256"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bitplanes.cluster(table(spark, sf_dir, "embeddings"), bitplanes.seed_key(F.col("vec_id")))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", bitplanes.digest(F.col("centroid")).alias("centroid_sha256"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    model = sentence_pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    docs = table(spark, sf_dir, "documents").select("doc_id", sentence_pieces.encode_and_decode(F.col("text"), model, spark).alias("s"))
    docs = docs.select("doc_id", "s.ids", "s.decoded")
    sha = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    return docs.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       sha(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"), sha(F.col("decoded")).alias("decoded_sha256"))


OPERATORS = (op1_toxicity, op2_quality, op3_line_dedup, op4_quality_rules, op5_packing, op6_chat_format, op7_simhash,
             op8_mixing, op9_pii, op10_neighbours, op11_runs, op12_centroids, op13_sentencepiece)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def shipped(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return f(spark, sf_dir)
        return run
    return {f.__name__: shipped(f) for f in OPERATORS}
