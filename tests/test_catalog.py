"""Catalogue changes: sequential create-or-reuse, patches, cascades, paging."""

from pyspark.sql import functions as F

from memtables.functions.json import labels_text, merge_labels
from memtables.operators import catalog as C
from memtables.operators import memories as M
from memtables.sources import tables as T

from conftest import SF_SMALL


def test_create_or_reuse_is_sequential(spark):
    spaces = T.spaces(spark, SF_SMALL)
    req = spark.createDataFrame(
        [(1, "src0", "e1", None, None, None),       # exists: reuse, its own embedder
         (2, "new", "e2", "fixed", 10, 10),         # invalid config: error
         (3, "new", "e3", "fixed", 10, 2),          # first valid: creates
         (4, "new", "e4", "bogus", None, None),     # later: reuses, config ignored
         (5, "other", "e5", "none", None, None)],
        "seq long, name string, embedder_id string, strategy string, chunk_size int, chunk_overlap int")
    rec, snap = C.create_or_reuse_spaces(spaces, req)
    got = {r.seq: r for r in rec.collect()}
    assert got[1].reused and got[1].embedder_id == "emb-64" and got[1].space_id == "src0"
    assert not got[2].success and "overlap" in got[2].error
    assert got[3].success and not got[3].reused and got[3].chunk_size == 10
    assert got[4].reused and got[4].space_id == got[3].space_id and got[4].embedder_id == "e3"
    assert got[5].success and got[5].strategy == "none" and got[5].chunk_size is None
    assert snap.count() == spaces.count() + 2


def test_merge_with_empty_changes_nothing(spark):
    df = spark.createDataFrame([({"a": "1"},)], "m map<string,string>")
    r = df.select(labels_text(merge_labels(F.col("m"), F.create_map().cast("map<string,string>"))).alias("t"),
                  labels_text(merge_labels(F.col("m"), F.create_map(F.lit("a"), F.lit("2")))).alias("u"),
                  labels_text(merge_labels(F.lit(None).cast("map<string,string>"),
                                           F.create_map(F.lit("b"), F.lit("3")))).alias("v")).first()
    assert r.t == "a=1" and r.u == "a=2" and r.v == "b=3"


def test_update_snapshot(spark):
    spaces = T.spaces(spark, SF_SMALL)
    patches = spark.createDataFrame(
        [("src1", "renamed", None, None, '{"x": 1}'), ("src2", None, True, "{}", None),
         ("nope", "n", None, None, None), ("src3", None, None, '{"a":1}', '{"b":2}')],
        "space_id string, name string, public_read boolean, replace_labels_json string, "
        "merge_labels_json string")
    rec, snap = C.update_spaces(spaces, patches)
    r = {x.space_id: x for x in rec.collect()}
    assert r["src1"].success and r["src1"].name == "renamed"
    assert not r["nope"].success and not r["src3"].success
    s = {x.space_id: x for x in snap.select("space_id", "name", "public_read",
                                             labels_text(F.col("labels")).alias("l")).collect()}
    assert s["src1"].name == "renamed" and s["src1"].l == "kind=docs;x=1"
    assert s["src2"].public_read and s["src2"].l == ""
    assert s["src3"].l == "kind=docs" and s["src0"].name == "src0"


def test_cascade_leaves_no_orphans(spark):
    mem = T.memories(spark, SF_SMALL)
    vec = T.chunk_vectors(spark, SF_SMALL)
    req = spark.createDataFrame([("src1",), ("src2",), ("missing",)], "space_id string")
    rec, sp2, mem2, _, vec2 = C.delete_spaces(req, T.spaces(spark, SF_SMALL), mem, vectors=vec)
    assert {r.space_id for r in rec.where("success").collect()} == {"src1", "src2"}
    assert sp2.where(F.col("space_id").isin("src1", "src2")).count() == 0
    assert mem2.where(F.col("space_id").isin("src1", "src2")).count() == 0
    gone = mem.where(F.col("space_id").isin("src1", "src2")).select("memory_id")
    assert vec2.join(gone, "memory_id", "left_semi").count() == 0
    # vectors filed under a deleted space go too
    _, _, _, _, vec_sp = C.delete_spaces(spark.createDataFrame([("label-3",)], "space_id string"),
                                         T.spaces(spark, SF_SMALL).unionByName(
                                             T.spaces(spark, SF_SMALL).limit(1).withColumn(
                                                 "space_id", F.lit("label-3"))),
                                         mem, vectors=vec)
    assert vec_sp.where(F.col("space_id") == "label-3").count() == 0
    assert vec_sp.count() == vec.where(F.col("space_id") != "label-3").count()
    mreq = mem2.select("memory_id").limit(5)
    rec2, mem3, _, vec3 = C.delete_memories(mreq, mem2, vectors=vec2)
    assert rec2.where("success").count() == 5
    assert vec3.join(mreq, "memory_id", "left_semi").count() == 0


def test_keyset_pages_equal_one_listing(spark):
    mem = T.memories(spark, SF_SMALL).cache()
    full = [r.memory_id for r in mem.where(F.col("space_id") == "src1")
            .orderBy("created_at", "memory_id").collect()]
    seen, token = [], None
    for _ in range(100):
        page = M.page_memories(mem, "src1", page_size=3, next_token=token).collect()
        seen += [r.memory_id for r in sorted(page, key=lambda r: r.position)]
        tokens = {r.next_token for r in page}
        assert len(tokens) == 1
        token = tokens.pop()
        if token is None:
            break
    assert seen == full
    allp = {r.memory_id: (r.page_no, r.position) for r in
            M.page_all(mem, page_size=3, partitions=4).where(F.col("space_id") == "src1").collect()}
    assert [allp[m][1] for m in full] == list(range(1, len(full) + 1))
    assert all(allp[m][0] == (i // 3) for i, m in enumerate(full))
    mem.unpersist()


def test_page_size_is_clamped(spark):
    df = spark.createDataFrame([(0,), (5000,), (None,)], "n int")
    assert [r.c for r in df.select(M.clamp_page_size(F.col("n")).alias("c")).collect()] == [1, 1000, 1000]


def test_hot_space_paging_and_listing(spark):
    """One space holds most rows: positions still run 1..n across range
    partitions, and a listing page is the first n by key."""
    mem = T.memories(spark, SF_SMALL).withColumn(
        "space_id", F.when(F.col("memory_id") % 4 != 0, F.lit("hot")).otherwise(F.col("space_id"))).cache()
    allp = M.page_all(mem, page_size=7, partitions=6).collect()
    by_space = {}
    for r in allp:
        by_space.setdefault(r.space_id, []).append(r)
    ref = {}
    for r in mem.select("space_id", "memory_id", "created_at").collect():
        ref.setdefault(r.space_id, []).append((r.created_at, r.memory_id))
    for sp, rs in by_space.items():
        order = [m for _, m in sorted(ref[sp])]
        got = [r.memory_id for r in sorted(rs, key=lambda r: r.position)]
        assert got == order
        assert [r.position for r in sorted(rs, key=lambda r: r.position)] == list(range(1, len(rs) + 1))
        assert sum(1 for r in rs if r.next_token) == (len(rs) - 1) // 7
    req = spark.createDataFrame([("r1", "hot", 5, None, None)],
                                "request_id string, space_id string, page_size int, next_token string, status string")
    page = M.list_memories(mem, req).orderBy("position").collect()
    assert [r.memory_id for r in page] == [m for _, m in sorted(ref["hot"])][:5]
    assert page[0].next_token is not None and page[0].total_memories == 5
    mem.unpersist()


def _patched(state, patches):
    """One space's patches one by one in plain Python: the state after each good one, by ``seq``."""
    out = {}
    for seq, name, public, replace, merge in sorted(patches):
        state = (name if name is not None else state[0], public if public is not None else state[1],
                 replace if replace is not None else {**state[2], **merge} if merge is not None else state[2])
        out[seq] = state
    return out


def test_patches_in_blocks_equal_one_by_one(spark):
    import json
    import random
    rnd = random.Random(7)
    spaces = T.spaces(spark, SF_SMALL)
    sizes = {"src1": 1200, "src2": 33, "src3": 32, "src4": 1}       # three levels, two, one
    given, rows = {}, []
    for space, n in sizes.items():
        given[space] = []
        for seq in rnd.sample(range(10_000), n):
            labels = {f"k{rnd.randrange(12)}": str(rnd.randrange(99)) for _ in range(rnd.randrange(3))}
            kind = rnd.choice(["none", "merge", "merge", "merge", "replace" if rnd.random() < 0.2 else "none"])
            name, public = rnd.choice([None, None, f"n{seq}"]), rnd.choice([None, True, False])
            given[space].append((seq, name, public, labels if kind == "replace" else None, labels if kind == "merge" else None))
            rows.append((space, seq, name, public, json.dumps(labels) if kind == "replace" else None,
                         json.dumps(labels) if kind == "merge" else None))
        rows.append((space, 20_000, "lost", None, "{}", "{}"))        # in error: changes nothing
    rows.append((None, 1, "lost", None, None, None))
    rnd.shuffle(rows)
    patches = spark.createDataFrame(rows, "space_id string, seq long, name string, public_read boolean, replace_labels_json string, merge_labels_json string")
    rec, snap = C.update_spaces(spaces, patches)
    got = {(r.space_id, r.seq): r for r in rec.collect()}
    assert len(got) == len(rows) and sum(not r.success for r in got.values()) == len(sizes) + 1
    after = {r.space_id: (r.name, r.public_read, r.labels) for r in snap.collect()}
    for r in spaces.collect():
        want = _patched((r.name, r.public_read, r.labels), given.get(r.space_id, []))
        for seq, state in want.items():
            x = got[r.space_id, seq]
            assert (x.name, x.public_read, x.labels) == state
        assert after[r.space_id] == (want[max(want)] if want else (r.name, r.public_read, r.labels))


def test_hot_space_of_patches_stays_on_the_jvm(spark):
    """40,000 patches of one space: no Python node, no window over the space, each block at most its bound."""
    n = 40_000
    patches = spark.range(n).select(F.lit("src1").alias("space_id"), F.col("id").alias("seq"), F.concat(F.lit("n"), F.col("id")).alias("name"),
                                    F.lit(None).cast("boolean").alias("public_read"), F.lit(None).cast("string").alias("replace_labels_json"),
                                    F.concat(F.lit('{"k'), F.col("id") % 5, F.lit('":"'), F.col("id"), F.lit('"}')).alias("merge_labels_json"))
    rec, snap = C.update_spaces(T.spaces(spark, SF_SMALL), patches)
    wrong = rec.where((F.col("name") != F.concat(F.lit("n"), "seq")) | (F.col("labels")[F.concat(F.lit("k"), F.col("seq") % 5)] != F.col("seq").cast("string")))
    assert rec.count() == n and wrong.count() == 0
    assert snap.where("space_id = 'src1'").first().labels == {"kind": "docs", **{f"k{(n - 1 - i) % 5}": str(n - 1 - i) for i in range(5)}}
    changes = spark.range(n).select(F.lit("s").alias("space_id"), F.col("id").alias("no"), F.struct(
        F.lit("a").alias("name"), F.lit(True).alias("public_read"), F.lit(False).alias("replaced"),
        F.create_map(F.lit("k"), F.col("id").cast("string")).alias("labels")).alias("change"))
    plan = C._running(changes, n)._jdf.queryExecution().executedPlan().toString()
    assert "InPandas" not in plan and "InArrow" not in plan and "Python" not in plan and "Window" not in plan


def test_default_page_size_takes_one_pass(spark):
    """1,001 and 1,000 memories of a space: a next page, and none; the table is scanned once."""
    from test_plans import _plan
    mem = spark.range(2001).select(F.col("id").alias("memory_id"), F.when(F.col("id") < 1001, "a").otherwise("b").alias("space_id"),
                                   F.lit("2024-01-01").cast("timestamp_ntz").alias("created_at"), F.lit("COMPLETED").alias("processing_status"))
    req = spark.createDataFrame([("a", "a", None, None, None), ("b", "b", None, None, None)],
                                "request_id string, space_id string, page_size int, next_token string, status string")
    page = M.list_memories(mem, req)
    got = page.groupBy("request_id").agg(F.count("*").alias("n"), F.max("position").alias("last"), F.max("next_token").alias("t"),
                                         F.max("total_memories").alias("total")).collect()
    got = {r.request_id: r for r in got}
    assert got["a"].n == got["b"].n == got["a"].last == got["a"].total == 1000 and got["a"].t and got["b"].t is None
    rest = M.list_memories(mem, spark.createDataFrame([("a", "a", None, got["a"].t, None)], req.schema)).collect()
    assert [r.memory_id for r in rest] == [1000]
    plan = _plan(page).split("== Initial Plan ==")[0]
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Range (0, 2001") == 1
