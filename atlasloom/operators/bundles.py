"""Load planning: parents before children, bundles of bounded size, dependencies between bundles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .hierarchy import depth_in_set


def load_order(resources: DataFrame) -> DataFrame:
    """resources: type, id, part_of, seq. Adds depth and `place` from 0: organizations first, then by depth in the set, then input order.

    Depths make few groups; within them a place is a prefix sum of counts per range of input order, so no single
    task sorts all resources.
    """
    keyed = resources.withColumn("_id", F.concat_ws("/", "type", "id"))
    parent = F.when(F.col("part_of").isNotNull(), F.concat_ws("/", "type", "part_of"))
    shape = keyed.select(F.col("_id").alias("id"), parent.alias("part_of"), "seq")
    found = depth_in_set(shape).select(F.col("id").alias("_k"), "depth", "dropped")
    rows = keyed.join(found, F.col("_id") == F.col("_k")).withColumn("group", F.struct((F.col("type") == "Location").alias("later"), "depth"))
    rows = rows.withColumn("run", F.floor(F.col("seq") / 10000))
    sizes = rows.groupBy("group", "run").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("group", "run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(F.col("group").alias("_g"), F.col("run").alias("_r"), before.alias("start"))
    rows = rows.join(starts, (F.col("group") == F.col("_g")) & (F.col("run") == F.col("_r")))
    nth = F.row_number().over(Window.partitionBy("group", "run").orderBy("seq"))
    return rows.withColumn("place", F.col("start") + nth - 1).select(*resources.columns, "depth", "dropped", "place")


def into_bundles(ordered: DataFrame, size: int = 100) -> DataFrame:
    return ordered.withColumn("bundle", F.floor(F.col("place") / size))


def dependencies(bundled: DataFrame, references: DataFrame) -> DataFrame:
    """(bundle, needs): earlier bundles that hold what a bundle's resources refer to. references: type, id, ref_type, ref_id."""
    at = bundled.select("type", "id", "bundle")
    held = at.select(F.col("type").alias("ref_type"), F.col("id").alias("ref_id"), F.col("bundle").alias("needs"))
    return references.join(at, ["type", "id"]).join(held, ["ref_type", "ref_id"]).where("needs < bundle").select("bundle", "needs").distinct()
