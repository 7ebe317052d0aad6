"""Session settings and shared work folders."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCAL_ROOTS: dict[str, str] = {}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("equisite")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def work_root(spark: SparkSession) -> str:
    """The shared folder for written intermediates.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master may fall back to a
    temporary folder, because there the driver's disk is every executor's disk.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="equisite-")
    return _LOCAL_ROOTS[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{work_root(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting that holds inside a ``with`` block."""
    was = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if was is None else spark.conf.set(key, was)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a relation that is read more than once and read it back.

    The written table cuts the lineage, survives lost executors, keeps column pruning and gives
    the planner a true size for its join choice. Its shuffle files go when it stands: else they stay until the driver
    happens to collect its garbage, and a chain of written steps holds the shuffles of them all.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    with setting(spark, CLEANUP_KEY, "true"):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
