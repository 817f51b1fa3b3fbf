"""Incremental snapshots as a stream: each micro-batch of document lines is merged into the snapshot table.

The reference dataflow is batch; this runs the same upsert by a high-water mark, so that replaying a batch gives
the same snapshot (the merge is idempotent). Windows and late data do not occur: the mark is a maximum, kept with
the snapshot's version.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import upsert


def _versions(spark: SparkSession, folder: str) -> list[int]:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    done = [n for n in names if n.startswith("v") and fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}/_SUCCESS"))]
    return sorted(int(n[1:]) for n in done)


def current(spark: SparkSession, folder: str) -> DataFrame | None:
    """The newest complete version of the snapshot: id, seq, text."""
    found = _versions(spark, folder)
    return spark.read.parquet(f"{folder}/v{found[-1]}") if found else None


def merge_batch(batch: DataFrame, number: int, folder: str) -> None:
    """Writes version number + 1 from the one before it; a repeated batch overwrites its own version alone."""
    spark = batch.sparkSession
    older = [v for v in _versions(spark, folder) if v <= number]
    new = batch.select(F.get_json_object("text", "$.id").alias("id"), F.lit(number).cast("long").alias("run"), F.monotonically_increasing_id().alias("row"), "text").where("id is not null")
    new = new.select("id", F.struct("run", "row").alias("seq"), "text")
    merged = upsert(spark.read.parquet(f"{folder}/v{older[-1]}"), new) if older else upsert(new.limit(0), new)
    merged.drop("source").write.mode("overwrite").parquet(f"{folder}/v{number + 1}")


def start(lines: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """lines: a stream with a column text, one document each. Ends when what is there has been merged."""
    return lines.writeStream.foreachBatch(lambda df, n: merge_batch(df, n, folder)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def fingerprint(plan: dict) -> str:
    """Equal for equal plans: a run is only resumed under the plan that began it."""
    import hashlib

    return hashlib.sha256(json.dumps(plan, sort_keys=True).encode()).hexdigest()


class Checkpoint:
    """Units of a plan that are done, kept as one small JSON file that is replaced as a whole."""

    def __init__(self, path: str, plan: dict):
        import os

        self.path, self.mark, self.done = path, fingerprint(plan), {}
        if os.path.exists(path):
            with open(path) as f:
                held = json.load(f)
            if held["plan"] != self.mark:
                raise ValueError("the checkpoint belongs to another plan")
            self.done = held["done"]

    def add(self, unit: str, output: str) -> None:
        import os

        self.done[unit] = output
        part = f"{self.path}.part"
        with open(part, "w") as f:
            json.dump({"plan": self.mark, "done": self.done}, f)
            f.flush()
            os.fsync(f.fileno())
        os.replace(part, self.path)
