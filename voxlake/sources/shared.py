"""The folder that driver and executors share, and tables written there to cut a plan in two."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package. Arrow batches stay as the session has them: Spark itself ends a batch
    with the row that passes spark.sql.execution.arrow.maxBytesPerBatch (64 MB if unset), so long texts do not add up."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if root not in paths.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, paths]))


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. It must be named; only a local master, where there is one machine, gets a
    temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="voxlake-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def table(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._voxlake_path = path
    return out


def drop(df: DataFrame) -> None:
    """Remove a table that table() wrote once nothing reads it any more."""
    spark, path = df.sparkSession, df._voxlake_path
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
