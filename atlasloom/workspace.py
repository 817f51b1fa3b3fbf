"""Tables that cut lineage: written to the shared folder that the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, removed when the driver's JVM ends; a local session gets a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="atlasloom-")
        spark.conf.set("spark.checkpoint.dir", shared)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared.rstrip('/')}/atlasloom-{uuid.uuid4().hex}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return str(path.toString())


def written(df: DataFrame, path: str) -> DataFrame:
    """df as a Parquet table, read back."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
