"""Session settings and shared scratch storage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession


def build_session(app: str = "oreflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Stream state on disk, so that it may outgrow executor memory.
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors are one process, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = context.applicationId
        if app not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="oreflow-")
        root = _LOCAL_ROOTS[app]
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch folder; nothing is created yet."""
    return os.path.join(scratch_root(spark), f"{label}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as a table and read it back.

    Used where several branches consume one expensive result. The written table
    cuts the lineage, survives lost executors, keeps column pruning and tells the
    optimizer its true size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_lean(df: DataFrame, label: str) -> DataFrame:
    """The same, and the shuffle files it took are deleted as soon as the table is written.

    For steps that shuffle much, and only for a ``df`` that is not used again.
    """
    spark, drop = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(drop, "false")
    spark.conf.set(drop, "true")
    try:
        return materialise(df, label)
    finally:
        spark.conf.set(drop, before)


def size_in_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the size of ``df``."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


# Rows that one task groups at most, on average. Rows of a few numbers compress so well that partitions of a fixed
# number of bytes would hold many more.
GROUPED_ROWS = 500_000


def grouped_by(df: DataFrame, rows: int, *keys: Column | str, task_rows: int = GROUPED_ROWS) -> DataFrame:
    """``df``, of about ``rows`` rows, partitioned by ``keys`` into as many tasks as its groups need to stay in memory."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-rows // task_rows)), *keys)


# Below this much input per core, files are too few to keep all cores busy.
_SMALL_PER_CORE = 16 << 20


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a small input over all cores before expensive work on each row.

    Large inputs already come in many splits and are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if size_in_bytes(df) < cores * _SMALL_PER_CORE else df
