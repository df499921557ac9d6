"""Physical-plan checks: pruning, pushdown, partial group limits, no
whole-table windows."""

import pytest
from pyspark.sql import functions as F

from memtables.functions.json import val, val_of
from memtables.operators import catalog as C
from memtables.operators import memories as M
from memtables.operators import postprocess as P
from memtables.operators import retrieval as R
from memtables.sources import files as FS
from memtables.sources import tables as T

from conftest import SF_SMALL


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _req(spark):
    return spark.createDataFrame([("r", "src1", 5, None, "COMPLETED")],
                                 "request_id string, space_id string, page_size int, next_token string, "
                                 "status string")


def test_listing_prunes_content_and_limits_before_shuffle(spark):
    page = M.list_memories(T.memories(spark, SF_SMALL), _req(spark))
    plan = _plan(page)
    assert "WindowGroupLimit" in plan
    scans = [l for l in plan.split("\n") if "FileScan parquet" in l and "documents" in l]
    assert scans and all("text" not in l.split("ReadSchema")[-1] for l in scans)


def test_written_tables_push_filters_and_prune_partitions(spark):
    paths = FS.write_memory_tables({"memories": T.memories(spark, SF_SMALL)}, spark=spark)
    mem = FS.read_memory_table(spark, paths["memories"])
    q = M.filter_by_status(FS.read_memory_table(spark, paths["memories"], ["src3"]), "COMPLETED")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(space_bucket" in plan
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "processing_status" in pushed and "space_id" in pushed
    assert q.count() == T.memories(spark, SF_SMALL).where(
        (F.col("space_id") == "src3") & (F.col("processing_status") == "COMPLETED")).count()
    # metadata paths still work after the round trip
    assert mem.where(val("$.k", "int") < 50).count() == T.memories(spark, SF_SMALL).where(
        val("$.k", "int") < 50).count()


def test_topk_group_limit_before_shuffle(spark):
    for method in ("blocks", "tiled"):
        top = R.retrieve_topk(T.retrieval_requests(spark, SF_SMALL), T.chunk_vectors(spark, SF_SMALL),
                              method=method)
        plan = _plan(top)
        assert plan.count("WindowGroupLimit") >= 2, method
        assert ("MapInArrow" in plan) == (method == "blocks")


def test_totals_without_whole_table_window(spark):
    plan = _plan(C.list_spaces(T.spaces(spark, SF_SMALL), ordered=False))
    assert "Subquery" in plan or "ScalarSubquery" in plan or "scalar-subquery" in plan
    assert "Window" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_files_do_not_grow_with_the_spaces(spark):
    many = spark.range(5000).select((F.col("id") + 1).alias("memory_id"), F.format_string("%04d", "id").alias("space_id"))
    paths = FS.write_memory_tables({"memories": many, "spaces": many.select("space_id")}, spark=spark, buckets=16)
    files = spark.read.parquet(paths["memories"]).select(F.input_file_name().alias("f")).distinct().count()
    assert files <= 16
    back = FS.read_memory_table(spark, paths["memories"], ["0007", "0012"], buckets=16)
    assert sorted(r.space_id for r in back.collect()) == ["0007", "0012"]
    assert FS.read_memory_table(spark, paths["spaces"], ["0007"]).collect()[0].space_id == "0007"


def test_one_retrieval_per_chain(spark, monkeypatch):
    """The search runs once, before: the chain's own plan holds none, with small and big tables."""
    req = T.retrieval_requests(spark, SF_SMALL, reranker_id="jaccard", relevance_threshold=0.05)
    chain = lambda: P.retrieve_postprocessed(
        req, T.chunk_vectors(spark, SF_SMALL), T.chunk_texts(spark, SF_SMALL), T.memories(spark, SF_SMALL))
    small = chain()
    assert "MapInArrow" not in _plan(small)
    monkeypatch.setattr(P.SZ, "SEMI_JOIN_REDUCTION_BYTES", 0)
    big = chain()
    assert "MapInArrow" not in _plan(big)
    assert sorted(map(tuple, small.collect()), key=str) == sorted(map(tuple, big.collect()), key=str)


def test_topk_of_many_queries_does_not_move_the_chunks(spark, monkeypatch):
    """100,000 queries in several blocks: no query row in the driver, no exchange between the vector scan and
    the kernel, the rows of the tiled form."""
    vec = T.chunk_vectors(spark, SF_SMALL)
    req = (T.retrieval_requests(spark, SF_SMALL).select("query_id", "query_vector", "space_ids").limit(500)
           .crossJoin(spark.range(200)).select((F.col("query_id") * 200 + F.col("id")).alias("query_id"), "query_vector", "space_ids"))
    assert req.count() == 100_000

    collect, got = type(req).collect, []

    def counted(self):
        got.append(collect(self))
        return got[-1]

    def refused(self, *a, **kw):
        raise AssertionError("query rows in the driver")
    with monkeypatch.context() as m:
        m.setattr(type(req), "toPandas", refused)
        m.setattr(type(req), "collect", counted)
        top = R.retrieve_topk(req, vec, default_k=1)
    assert sum(map(len, got)) <= 1                          # one row of counts
    plan = _plan(top)
    final = plan.split("== Initial Plan ==")[0]
    assert "MapInArrow" in final and "Exchange" not in final.split("MapInArrow")[1]
    tiled = R.retrieve_topk(req, vec, default_k=1, method="tiled")
    assert top.count() == 100_000 and top.exceptAll(tiled).count() == 0 and tiled.exceptAll(top).count() == 0


def test_topk_of_many_small_spaces(spark):
    """Thousands of spaces of a few chunks beside a hot one; two vector lengths, ties, null spaces."""
    v = lambda i, n: F.transform(F.sequence(F.lit(1), n), lambda j: F.sin((i * j) % 23).cast("float"))
    i = F.col("id")
    space = F.when(i % 3 == 0, "hot").when(i % 101 == 0, F.lit(None)).otherwise(F.concat(F.lit("s"), (i % 2000).cast("string")))
    size = F.when(i % 5 == 0, 4).otherwise(6)
    rows = spark.range(9000).select(i, space.alias("space_id"), v(i, size).alias("v"))
    chunks = rows.select(i.alias("chunk_id"), (i % 50).alias("memory_id"), "space_id", F.col("v").alias("embedding")).repartition(3)
    req = rows.where(i % 4 == 0).select(i.alias("query_id"), F.col("v").alias("query_vector"), F.concat_ws(",", F.lit("hot"), "space_id").alias("space_ids"))
    got = [sorted(map(tuple, R.retrieve_topk(req, chunks, default_k=3, method=m).collect())) for m in ("blocks", "tiled")]
    assert got[0] == got[1] and len(got[0]) > 6000           # zero vectors (multiples of 23) match nothing


def test_search_prunes_folders_by_the_request_table(spark):
    """The folders to read come from the request table at run time."""
    many = spark.range(4000).select(F.col("id").alias("chunk_id"), F.col("id").alias("memory_id"), F.format_string("s%d", F.col("id") % 400).alias("space_id"),
                                    F.array(F.lit(1.0), F.col("id").cast("double")).cast("array<float>").alias("embedding"))
    paths = FS.write_memory_tables({"vectors": many}, spark=spark)
    vec = FS.read_memory_table(spark, paths["vectors"], layout=True)
    req = spark.createDataFrame([(1, [1.0, 2.0], "s7"), (2, [1.0, 9.0], "s8, s7")], "query_id long, query_vector array<float>, space_ids string")
    top = R.retrieve_topk(req, vec)
    want = sorted(map(tuple, R.retrieve_topk(req, vec, method="tiled").collect()))
    assert sorted(map(tuple, top.collect())) == want and len(want) == 10
    plan = top._jdf.queryExecution().executedPlan()
    assert "dynamicpruning" in plan.toString()
    folders = set()

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if name.startswith("Scan parquet") and node.metrics().contains("numPartitions"):
            folders.add(node.metrics().apply("numPartitions").value())
        children = node.children().iterator()
        while children.hasNext():
            walk(children.next())
    walk(plan)
    assert folders and min(folders) <= 2


def test_topk_prunes_space_partitions(spark):
    paths = FS.write_memory_tables({"vectors": T.chunk_vectors(spark, SF_SMALL)}, spark=spark)
    vec = FS.read_memory_table(spark, paths["vectors"], ["label-2", "label-3"])
    req = T.retrieval_requests(spark, SF_SMALL).where(F.col("query_id") < 10).withColumn(
        "space_ids", F.lit("label-2, label-3"))
    top = R.retrieve_topk(req, vec, method="blocks")
    plan = _plan(top)
    scan = [l for l in plan.split("\n") if "FileScan parquet" in l][0]
    assert "PartitionFilters: [" in scan and "label-2" in scan and "label-3" in scan
    assert {r.space_id for r in top.collect()} <= {"label-2", "label-3"}


def test_metadata_paths_reach_the_scan(spark, tmp_path):
    mem = T.memories(spark, SF_SMALL)
    paths = FS.write_memory_tables({"memories": mem}, root=str(tmp_path), spark=spark, paths={"meta_k": ("$.k", "integer")})
    stored = FS.read_memory_table(spark, paths["memories"])
    small = lambda v: v("$.k", "int") < 50
    want = sorted(r[0] for r in mem.where(small(val)).select("memory_id").collect())
    q = M.filter_by_metadata(stored, small).select("memory_id")
    assert sorted(r[0] for r in q.collect()) == want and want
    plan = _plan(q)
    assert "LessThan(meta_k,50)" in plan.split("PushedFilters: [")[1].split("]")[0] and "variant" not in plan
    # other paths and types, and tables without such columns, read the VARIANT
    for df, path, type_ in ((stored, "$.k", "string"), (stored, "$.j", "int"), (mem, "$.k", "int")):
        assert "variant_get" in df.select(val_of(df)(path, type_).alias("x"))._jdf.queryExecution().analyzed().toString()
    page = M.list_memories(stored, _req(spark), where=small)
    assert [r.memory_id for r in page.collect()] == [r.memory_id for r in M.list_memories(mem, _req(spark), where=small(val)).collect()]
    with pytest.raises(ValueError):
        FS.write_memory_tables({"memories": mem}, root=str(tmp_path / "x"), spark=spark, paths={"Space_ID": ("$.k", "int")})
