"""Tables that one plan writes for another to read, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a temporary folder on a local master only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        own = tempfile.mkdtemp(prefix="leadlink-")
        atexit.register(shutil.rmtree, own, True)
        base = f"file://{own}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table of its own: its plan runs once, and a lost executor costs only tasks. The table
    goes when the application ends."""
    spark = df.sparkSession
    at = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(at)
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(at)
