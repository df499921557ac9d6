"""File sources and table sinks (ops 2, 12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memtables.functions.json import with_path_columns
from memtables.session import shared_dir


FILE_ROW = "path string, modificationTime timestamp, length long, content binary"


def read_files(spark: SparkSession, path: str, glob: str | None = None,
               recursive: bool = True, max_bytes: int | None = None) -> DataFrame:
    """Files under ``path`` as rows ``path, modificationTime, length, content``
    (Spark's ``binaryFile`` source). Every file is read whole; only if the caller
    sets ``max_bytes``, files over it keep their row with null content (an ingest error row)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(path)
    return df if max_bytes is None else df.withColumn("content", F.when(F.col("length") <= max_bytes, F.col("content")))


def stream_files(spark: SparkSession, path: str, max_bytes: int | None = None, max_files: int = 1000) -> DataFrame:
    """Files as they arrive under ``path``, like :func:`read_files`; a batch takes at most ``max_files`` of
    them. Files over ``max_bytes`` keep their row with null content (an ingest error row)."""
    r = spark.readStream.format("binaryFile").schema(FILE_ROW).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files)
    df = r.load(path)
    return df if max_bytes is None else df.withColumn("content", F.when(F.col("length") <= max_bytes, F.col("content")))


def write_page_files(pages: DataFrame, path: str, file: F.Column) -> None:
    """Pages as text files ``path/file=<n>/part-*.txt``, one per value of ``file``, a page after another by
    id, each ended by a newline."""
    rows = pages.select(file.alias("file"), "page_id", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.repartition("file").sortWithinPartitions("file", "page_id")
    rows.select("file", "html").write.partitionBy("file").text(path)


def file_requests(files: DataFrame, space_id: str | F.Column) -> DataFrame:
    """Files as create-memory requests (file wins over text)."""
    sp = F.lit(space_id) if isinstance(space_id, str) else space_id
    return files.select(F.col("path").alias("request_id"), sp.alias("space_id"),
                        F.col("path").alias("file_path"), F.col("content").alias("file_content"))


BUCKETS = 64


def space_bucket(space_id: F.Column, buckets: int = BUCKETS) -> F.Column:
    """The folder of a space in a written table."""
    return F.pmod(F.xxhash64(space_id), F.lit(buckets)).cast("int")


def write_memory_tables(tables: dict[str, DataFrame], root: str | None = None,
                        spark: SparkSession | None = None, mode: str = "overwrite",
                        buckets: int = BUCKETS, paths: dict[str, tuple[str, str]] | None = None) -> dict[str, str]:
    """Writes entity tables as Parquet under ``root`` (default: a fresh folder in
    the session's shared checkpoint folder). Returns the paths.

    Tables with rows of many memories to a space (``space_id`` and ``memory_id``) are laid out
    in a fixed number of folders by the hash of ``space_id``, whose rows are sorted by
    it: reading some spaces prunes folders and row groups, and the number of files
    doesn't grow with the spaces. Rows are rebalanced by size, so a hot space fills
    several files. ``space_id`` stays a data column of its own type.

    ``paths`` (``name: (path, type)``) copies hot paths of ``metadata`` to typed columns, by which metadata
    filters written with ``val_of`` prune; rows of a folder are then sorted by them within a space."""
    if root is None:
        spark = spark or next(iter(tables.values())).sparkSession
        root = shared_dir(spark, "tables")
    out = {}
    for name, df in tables.items():
        path = f"{root.rstrip('/')}/{name}"
        by = []
        if paths and "metadata" in df.columns:
            df, by = with_path_columns(df, paths), list(paths)
        if {"space_id", "memory_id"} <= set(df.columns):
            df = (df.withColumn("space_bucket", space_bucket(F.col("space_id"), buckets)).hint("rebalance", "space_bucket")
                  .sortWithinPartitions("space_bucket", "space_id", *by))
            df.write.mode(mode).partitionBy("space_bucket").parquet(path)
        else:
            df.write.mode(mode).parquet(path)
        out[name] = path
    return out


def read_memory_table(spark: SparkSession, path: str, space_ids: list[str] | None = None, buckets: int = BUCKETS,
                      layout: bool = False) -> DataFrame:
    """A table of :func:`write_memory_tables` (with its ``buckets``); with ``space_ids`` only
    those spaces, by folder and by row-group statistics. ``layout`` keeps the folder column ``space_bucket``, by
    which a search prunes folders at run time."""
    df = spark.read.parquet(path)
    if space_ids is not None:
        df = df.where(F.col("space_id").isin(space_ids))
        if "space_bucket" in df.columns:
            df = df.where(F.col("space_bucket").isin([space_bucket(F.lit(s), buckets) for s in space_ids]))
    return df if layout else df.drop("space_bucket")
