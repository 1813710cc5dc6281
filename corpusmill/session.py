"""Session construction and the shared working folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "corpusmill", **conf: str) -> SparkSession:
    """A session with the settings that every operator here is written for."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for k, v in {**settings, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


#: A table of fewer bytes for each core, in fewer files than there are cores, is dealt out to all of them.
SMALL_SHARE = 4 << 20


def spread(df: DataFrame) -> DataFrame:
    """A small table in few files, whose row groups only few tasks could read, over all cores; any other as it is.

    Larger tables have row groups enough, and are never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if cores < 2 or size > SMALL_SHARE * cores or len(df.inputFiles()) >= cores:
        return df
    return df.repartition(cores)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is the one named in ``spark.checkpoint.dir``. Only where that is unset,
    as in local tests, a temporary folder is made and used instead.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):  # local-cluster has executors of its own
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(os.path.join(tempfile.gettempdir(), f"corpusmill-{os.getpid()}"))
    return sc._jsc.sc().getCheckpointDir().get()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a working table in the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark).rstrip('/')}/tables-{app}/{name}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a working table through Hadoop's file system API."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


#: The working tables of each scope that is open, the innermost last.
_scopes: list[list[str]] = []


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Working tables that are made inside are deleted at its end. What is computed from them must be written by then."""
    own: list[str] = []
    _scopes.append(own)
    try:
        yield
    finally:
        _scopes.remove(own)
        for path in own:
            drop_path(spark, path)


#: Rows of an Arrow batch while a working table is written. Whole texts go between the JVM and its workers, and several batches are held at a time.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of BATCH_ROWS rows at most for what is executed inside."""
    before = spark.conf.get(_BATCH)
    if 0 < int(before) <= BATCH_ROWS:
        yield
        return
    spark.conf.set(_BATCH, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def write_table(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> str:
    """Write df as Parquet in the shared folder; returns the path."""
    path = table_path(df.sparkSession, name)
    w = df.write.option("compression", "zstd")
    with small_batches(df.sparkSession):
        (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written once in the shared folder and read back: lineage is cut, work is not repeated.

    The table is deleted with the scope in which it is made; without one it stays, for df may be read at any time.
    """
    path = write_table(df, name)
    if _scopes:
        _scopes[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
