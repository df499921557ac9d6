"""Ingest from real files (binaryFile source), outcome rows, and the
indexing stream (stream = batch; a rerun over the same checkpoint adds
nothing)."""

import os
import tempfile

from pyspark.sql import functions as F

from memtables.sources import files as FS
from memtables.sources import ingest as I
from memtables.sources import tables as T
from memtables.streaming import indexing as IX
from memtables.operators import chunking as CH

from conftest import SF_SMALL


def test_files_to_memories(spark):
    d = tempfile.mkdtemp(prefix="memtables-files-")
    payload = {"a.PDF": b"%PDF-1", "b.txt": b"caf\xc3\xa9 \xff", "c.docx": b"PK", "d": b"\x00\x01",
               "e.md": b"# t"}
    for name, data in payload.items():
        with open(os.path.join(d, name), "wb") as f:
            f.write(data)
    files = FS.read_files(spark, d)
    out = I.ingest(FS.file_requests(files, "sp")).collect()
    by = {os.path.basename(r.request_id): r for r in out}
    assert by["a.PDF"].content_type == "application/pdf" and by["a.PDF"].original_content_b64 == "JVBERi0x"
    assert by["b.txt"].content_type == "text/plain" and by["b.txt"].original_content == "café �"
    assert by["c.docx"].content_type.endswith("wordprocessingml.document")
    assert by["d"].content_type == "application/octet-stream"
    assert by["e.md"].content_type == "text/markdown" and by["e.md"].original_content == "# t"
    assert all(r.success for r in out)


def test_ingest_rules(spark):
    req = spark.createDataFrame(
        [(1, "s", "hello", None, None, '{"source":"email","author":"John"}'),
         (2, "s", "", None, None, None),
         (3, "s", "   ", None, None, "{}"),
         (4, "s", "x", None, None, "[1]"),
         (5, "s", "x", "/f.txt", bytearray(b"file wins"), None),
         (6, "s", "x", "/gone.pdf", None, None),
         (7, "s", "", None, None, "{bad")],
        "request_id long, space_id string, text string, file_path string, file_content binary, "
        "metadata_json string")
    got = {r.request_id: r for r in I.ingest(req).collect()}
    assert got[1].success and got[1].content_type == "text/plain"
    assert not got[2].success and "No content" in got[2].error
    assert got[3].success and got[3].metadata is None
    assert not got[4].success and "Metadata" in got[4].error
    assert got[5].source_kind == "file" and got[5].original_content == "file wins"
    assert not got[6].success and "Failed to read file" in got[6].error
    assert not got[7].success and "Metadata" in got[7].error   # metadata is checked first
    ack = I.ingest_ack(I.ingest(req)).collect()
    assert {r.status for r in ack} == {"PENDING"} and len(ack) == 3


def test_stream_equals_batch_and_rerun_adds_nothing(spark):
    stream = IX.documents_stream(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="memtables-stream-")
    q = IX.stream_index_memories(stream, f"{root}/out", f"{root}/ck")
    q.awaitTermination()
    status = IX.latest_status(spark, f"{root}/out")
    vectors = IX.indexed_vectors(spark, f"{root}/out")
    mem = T.memories(spark, SF_SMALL).select("memory_id", "space_id", "original_content")
    batch_chunks = CH.chunk_recursive(mem, 512, 50)
    assert status.count() == mem.count()
    assert vectors.count() == batch_chunks.count()
    from memtables.operators.embedding import embed_chunks
    batch_vec = {r.chunk_id: list(r.embedding) for r in embed_chunks(batch_chunks).collect()}
    stream_vec = {r.chunk_id: list(r.embedding) for r in vectors.collect()}
    assert stream_vec == batch_vec
    assert vectors.select(F.size("embedding").alias("d")).distinct().collect()[0].d == 256
    q2 = IX.stream_index_memories(IX.documents_stream(spark, SF_SMALL), f"{root}/out", f"{root}/ck")
    q2.awaitTermination()
    again = IX.latest_status(spark, f"{root}/out")
    assert again.count() == mem.count() and again.where("attempt <> 1").count() == 0
    assert IX.indexed_vectors(spark, f"{root}/out").count() == vectors.count()


def test_conversation_search_resorts_by_turn(spark):
    import __spark_entry__ as E
    rows = E.queries()["conversation_search"](spark, SF_SMALL).collect()
    assert rows
    by_q = {}
    for r in rows:
        by_q.setdefault(r.query_id, []).append(r)
    for rs in by_q.values():
        rs.sort(key=lambda r: r.rank)
        times = [r.created_at for r in rs]
        assert times == sorted(times)
        assert len({r.memory_id for r in rs}) == len(rs)
    # a user turn finds itself (same text, score 1.0) in its own conversation
    assert all(any(r.memory_id == q for r in rs) for q, rs in by_q.items())


def test_stream_with_space_configs(spark):
    spaces = T.spaces(spark, SF_SMALL).withColumn(
        "chunking", F.when(F.col("space_id") == "src1", F.struct(F.lit("none").alias("strategy"),
                                                                 F.lit(None).cast("int").alias("chunk_size"),
                                                                 F.lit(None).cast("int").alias("chunk_overlap")))
        .otherwise(F.col("chunking")))
    root = tempfile.mkdtemp(prefix="memtables-stream-")
    q = IX.stream_index_memories(IX.documents_stream(spark, SF_SMALL), f"{root}/out", f"{root}/ck",
                                 chunker=IX.space_chunker(spaces))
    q.awaitTermination()
    st = IX.latest_status(spark, f"{root}/out")
    one = st.where(F.col("space_id") == "src1")
    assert one.count() > 0 and one.where(F.col("n_chunks") != 1).count() == 0
    assert st.where(F.col("processing_status") != "COMPLETED").count() == 0
