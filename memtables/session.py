"""Session helpers: a local session for tests / bench, and the shared folder for
checkpoints and written tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "memtables") -> SparkSession:
    """A local session for tests and the benchmark. On a cluster, use the
    session the platform gives you; nothing in the library depends on these
    settings except the checkpoint folder (see :func:`shared_dir`)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("MEMTABLES_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.pythonUDF.arrow.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` from the session. Only when it is unset (a
    local test session) a scratch folder is made and set, so that
    ``DataFrame.checkpoint()`` and the streaming checkpoints work the same way.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="memtables-")
        try:
            spark.conf.set("spark.checkpoint.dir", base)
        except Exception:  # noqa: BLE001  (a core setting some sessions refuse at runtime)
            pass
        spark.sparkContext.setCheckpointDir(base)
    elif spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(base)
    return "/".join([base.rstrip("/"), *parts, uuid.uuid4().hex])


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Makes ``memtables`` importable in the Python workers (pandas / Arrow
    functions refer to it): zips the package once per application and adds
    it with ``addPyFile``. The zip goes to the shared checkpoint folder when
    the session names one, else next to the driver."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import shutil
    pkg = os.path.dirname(os.path.abspath(__file__))
    base = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="memtables-py-")
    if base.startswith("file:"):
        base = base[len("file:"):]
    if "://" in base:
        # remote shared folder: build locally, Spark distributes the file itself
        base = tempfile.mkdtemp(prefix="memtables-py-")
    os.makedirs(base, exist_ok=True)
    target = os.path.join(base, f"memtables-{uuid.uuid4().hex}")
    archive = shutil.make_archive(target, "zip", root_dir=os.path.dirname(pkg), base_dir="memtables")
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def materialized(df):
    """Writes ``df`` once as Parquet into a fresh folder of the session's shared
    checkpoint folder and reads it back: computed once, lineage cut, and it
    survives executor loss. (An eager ``checkpoint()`` of an uncached plan
    would compute it twice.)"""
    spark = df.sparkSession
    path = shared_dir(spark, "stage")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
