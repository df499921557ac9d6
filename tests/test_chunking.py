"""Chunking properties and a plain-Python reference for sentence packing."""

import re

from pyspark.sql import functions as F

from memtables.operators import chunking as CH
from memtables.sources import tables as T

from conftest import SF_SMALL

TEXTS = ["", "...", "One. Two! Three? ", "a" * 1300, "Short. " * 200, "x.\n\ny " * 150 + "!?",
         "Mixed sentence. " + "b" * 700 + ". tail", "no end at all " * 90]


def _mem(spark, texts):
    return spark.createDataFrame([(i, "s", t) for i, t in enumerate(texts)],
                                 "memory_id long, space_id string, original_content string")


def _by_mem(df):
    out = {}
    for r in df.orderBy("memory_id", "chunk_index").collect():
        out.setdefault(r.memory_id, []).append(r.chunk_text)
    return out


def ref_pack_units(units, size, ov, too_long):
    done, cur, tail = [], "", []
    for s in units:
        if len(s) > size:
            if cur:
                done.append(cur)
            done.extend(too_long(s))
            cur, tail = "", []
        elif cur == "":
            cur, tail = s, [s]
        elif len(cur) + len(s) <= size:
            cur, tail = cur + s, tail + [s]
        else:
            done.append(cur)
            carry, n = [], 0
            for x in reversed(tail):
                if n + len(x) <= min(ov, size - len(s)):
                    carry.insert(0, x)
                    n += len(x)
                else:
                    break
            cur, tail = "".join(carry) + s, carry + [s]
    if cur:
        done.append(cur)
    return done


def ref_pack(text, size, ov):
    sents = re.findall(CH.SENTENCE_PATTERN, text)
    return ref_pack_units(sents, size, ov, lambda s: ref_fixed(s, size, ov)) or [""]


def ref_recursive(text, size, ov, level=0):
    if level == len(CH.RECURSIVE_LEVELS):
        return ref_fixed(text, size, ov)
    units = re.findall(CH.RECURSIVE_LEVELS[level].replace("\\z", "\\Z"), text)
    out = ref_pack_units(units, size, ov, lambda s: ref_recursive(s, size, ov, level + 1))
    return out if level else (out or [""])


def ref_fixed(t, size, ov):
    step = size - ov
    return [t[i:i + size] for i in range(0, max(len(t) - ov - 1, 0) + 1, step)]


def test_fixed_rejoin_gives_text_back(spark):
    for size, ov in ((100, 20), (10, 8), (7, 0), (512, 50)):
        got = _by_mem(CH.chunk_fixed(_mem(spark, TEXTS + ["é" * 33 + "😀" * 9]), size, ov))
        for i, t in enumerate(TEXTS + ["é" * 33 + "😀" * 9]):
            chunks = got[i]
            assert chunks == ref_fixed(t, size, ov), (size, ov, i)
            assert all(len(c) <= size for c in chunks)
            joined = chunks[0] + "".join(c[ov:] for c in chunks[1:])
            assert joined == t


def test_sentence_matches_reference(spark):
    for size, ov in ((512, 50), (64, 16)):
        got = _by_mem(CH.chunk_sentence(_mem(spark, TEXTS), size, ov))
        for i, t in enumerate(TEXTS):
            assert got[i] == ref_pack(t, size, ov), (i, size)
            assert all(len(c) <= size for c in got[i])


def test_sentence_pattern_loses_nothing():
    for t in TEXTS:
        assert "".join(re.findall(CH.SENTENCE_PATTERN, t)) == t


def test_recursive_matches_reference(spark):
    texts = TEXTS + ["para one.\n\npara two is here\nwith a line\n\n\n" + "w" * 300 + " tail\n"]
    for size, ov in ((120, 20), (512, 50), (16, 4)):
        got = _by_mem(CH.chunk_recursive(_mem(spark, texts), size, ov))
        for i, t in enumerate(texts):
            assert got[i] == ref_recursive(t, size, ov), (size, ov, i)
            assert all(len(c) <= size for c in got[i])


def test_recursive_units_lose_nothing():
    for t in TEXTS:
        for lv in CH.RECURSIVE_LEVELS:
            assert "".join(re.findall(lv.replace("\\z", "\\Z"), t)) == t


def test_whole_table_chunk_counts(spark):
    mem = T.memories(spark, SF_SMALL).select("memory_id", "space_id", "original_content")
    n_docs = mem.count()
    fixed = CH.chunk_fixed(mem, 512, 50)
    assert fixed.select("memory_id").distinct().count() == n_docs
    assert fixed.where(F.length("chunk_text") > 512).count() == 0


def test_chunk_by_space_config(spark):
    mem = _mem(spark, TEXTS).withColumn("space_id", F.concat(F.lit("s"), (F.col("memory_id") % 4).cast("string")))
    spaces = spark.createDataFrame(
        [("s0", ("none", None, None)), ("s1", ("fixed", 64, 8)), ("s2", ("sentence", 128, 16)),
         ("s3", ("recursive", 100, 10))],
        "space_id string, chunking struct<strategy:string,chunk_size:int,chunk_overlap:int>")
    got = _by_mem(CH.chunk_by_config(mem, spaces))
    for i, t in enumerate(TEXTS):
        kind = i % 4
        if kind == 0:
            assert got[i] == [t]
        elif kind == 1:
            assert got[i] == ref_fixed(t, 64, 8)
        elif kind == 2:
            assert got[i] == ref_pack(t, 128, 16)
        else:
            assert got[i] == ref_recursive(t, 100, 10)


def test_fixed_windows_property(spark):
    """Random texts (letters, spaces, punctuation, newlines, non-BMP) in one
    job per example: windows equal slicing by code points."""
    from hypothesis import given, settings, strategies as st

    alphabet = st.sampled_from(list("ab .!?\n\té") + ["😀"])
    texts = st.lists(st.text(alphabet, max_size=400), min_size=1, max_size=12)

    @settings(max_examples=6, deadline=None)
    @given(texts, st.integers(2, 60), st.integers(0, 59))
    def check(ts, size, ov):
        ov = ov % size
        got = _by_mem(CH.chunk_fixed(_mem(spark, ts), size, ov))
        for i, t in enumerate(ts):
            assert got[i] == ref_fixed(t, size, ov)
        packed = _by_mem(CH.chunk_sentence(_mem(spark, ts), size, ov))
        for i, t in enumerate(ts):
            assert packed[i] == ref_pack(t, size, ov)

    check()


def test_recursive_sql_engine_equals_python(spark):
    texts = TEXTS + ["para one.\n\npara two is here\nwith a line\n\n\n" + "w" * 300 + " tail\n"]
    for size, ov in ((120, 20), (40, 8)):
        py = _by_mem(CH.chunk_recursive(_mem(spark, texts), size, ov))
        jvm = _by_mem(CH.chunk_recursive(_mem(spark, texts), size, ov, engine="sql"))
        assert py == jvm


def test_any_number_of_configs_in_one_pass(spark):
    """One scan of the memories, no job while the plan is built; odd configs take the default."""
    import __spark_entry__ as E
    plan = E.queries()["chunk_by_config"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Union") == 0 and plan.count("ArrowEvalPython") == 1
    text = "One two three. Four five six seven. " * 40
    memories = spark.createDataFrame([(i, s, text) for i, s in enumerate(["a", "b", "c", "d", "e", "gone", None])], "memory_id long, space_id string, original_content string")
    configs = [("a", ("none", None, None)), ("b", ("fixed", 100, 10)), ("c", ("sentence", 90, 20)), ("d", ("recursive", 80, 5)), ("e", ("recursive", 10, 10))]
    spaces = spark.createDataFrame(configs, "space_id string, chunking struct<strategy:string,chunk_size:int,chunk_overlap:int>")
    got = {}
    for r in CH.chunk_by_config(memories, spaces).orderBy("memory_id", "chunk_index").collect():
        got.setdefault(r.memory_id, []).append(r.chunk_text)
    one = memories.where("memory_id = 0")
    texts = lambda df: [r.chunk_text for r in df.orderBy("chunk_index").collect()]
    default = texts(CH.chunk_recursive(one, 512, 50))
    assert got == {0: [text], 1: texts(CH.chunk_fixed(one, 100, 10)), 2: texts(CH.chunk_sentence(one, 90, 20)),
                   3: texts(CH.chunk_recursive(one, 80, 5)), 4: default, 5: default, 6: default}
