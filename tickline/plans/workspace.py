"""Where the engine keeps tables between its steps."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in spark.checkpoint.dir, which driver and executors share. Only a local master may go without that setting."""
    folder, master = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master
    if not folder:
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="tickline-")
    return f"{folder}/{name}-{uuid.uuid4().hex}"
