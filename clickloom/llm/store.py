"""Lineage cuts in the folder that the cluster shares."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ROWS, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2000
_LEFT: dict[str, SparkSession] = {}  # folders that results still read


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; a temporary folder where it is unset and all runs on one machine."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        given = spark.conf.get("spark.checkpoint.dir", None)
        if given is None and sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(given or tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


def small_batches(spark: SparkSession) -> None:
    """From now on the session sends its Python workers at most BATCH_ROWS rows at a time, which bounds the memory of whole texts."""
    if not 0 < int(spark.conf.get(_ROWS)) <= BATCH_ROWS:
        spark.conf.set(_ROWS, BATCH_ROWS)


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    _LEFT.pop(path, None)


def remove_later(spark: SparkSession, path: str) -> None:
    """A folder that results still read goes when the driver ends."""
    _LEFT[path] = spark


@atexit.register
def _remove_all() -> None:
    for path, spark in list(_LEFT.items()):
        with contextlib.suppress(Exception):  # the session may be gone
            remove(spark, path)


class Scratch:
    """Tables of one run of an operator, written as Parquet to the shared folder, so that a lost executor costs no recomputation.

    `settled` writes a table and frees the shuffle files behind it; `drop` removes tables that nothing reads any more.
    Tables that a result still reads are removed when the driver ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.path = spark, f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}"
        self.names: dict[int, str] = {}
        small_batches(spark)
        remove_later(spark, self.path)

    def settled(self, df: DataFrame) -> DataFrame:
        path, before = f"{self.path}/{uuid.uuid4().hex}", self.spark.conf.get(_CLEANUP)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(_CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.names[id(out)] = path
        out._scratch = self  # so that id(out) stays taken while the table is in use
        return out

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            remove(self.spark, self.names.pop(id(df)))


def settled(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read from there."""
    return Scratch(df.sparkSession).settled(df)
