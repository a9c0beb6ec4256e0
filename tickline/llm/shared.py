"""Small helpers that several operators need."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it. Only a local master may go without one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="tickline-"))
    return sc.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path for a table within the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written once to the shared folder; the plan starts anew from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once as a table in the shared folder, whose size the planner knows."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


#: Bytes of an Arrow batch that goes to a Python worker, unless one row is longer. Spark's own limit is 10,000 rows, whatever their texts.
BATCH_BYTES = 4 << 20


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What is executed within sends rows to Python in batches of BATCH_BYTES: executors and their workers hold a batch several times over."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def sweep(spark: SparkSession) -> None:
    """Shuffle files of finished plans go: Spark deletes them once the driver has collected its garbage, which a large heap puts off."""
    spark.sparkContext._jvm.System.gc()


class Scratch:
    """Tables of one run in the shared folder, each of which goes once nothing reads it any more."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.folder, self.count = spark, new_folder(spark, name), 0

    def store(self, df: DataFrame) -> DataFrame:
        """The same rows, written once; the planner knows the table's size."""
        self.count += 1
        path = f"{self.folder}/{self.count}"
        # a writer holds a row group in memory
        df.write.option("parquet.block.size", 16 << 20).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        """Deletes tables that no later plan reads."""
        for df in tables:
            if df is not None:
                at = self.spark._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
                at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)
