"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Only settings that hold at any size. The number of shuffle partitions is left to the cluster:
# adaptive execution merges small partitions, so a generous cluster value costs little.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

_scratch: dict[str, str] = {}


def get_session(app: str = "burgage", master: str | None = None, **extra: str) -> SparkSession:
    """Build or reuse a session. `extra` keys use `__` for dots: spark__driver__memory="8g"."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Where that is unset, a folder below the session's warehouse. On a cluster a warehouse on the
    local disk is no shared folder: that is an error, not files that others cannot see.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    local = warehouse.startswith("file:") or "://" not in warehouse
    if local and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse}/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder, removed when the application ends.

    All paths of an application lie in one folder, which Hadoop deletes as its JVM exits.
    """
    app = spark.sparkContext.applicationId
    if app not in _scratch:
        jvm = spark.sparkContext._jvm
        folder = f"{shared_folder(spark).rstrip('/')}/{app}-{uuid.uuid4().hex[:8]}"
        path = jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _scratch[app] = folder
    return f"{_scratch[app]}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the shared folder, read again: cuts the lineage and outlives executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def freed(spark: SparkSession) -> None:
    """Let go of the shuffles behind tables that are written: Spark removes the files of a shuffle when the
    driver's JVM finds that nothing refers to it, which may take long on a driver with little to do."""
    spark.sparkContext._jvm.System.gc()


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a cleaned table in memory, or on disk where it does not fit, for several reports.

    Blocks of a lost executor are computed again. For tables that outlive the job, or that are
    larger than the cluster's memory, store them with `write_table` instead.
    """
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()
