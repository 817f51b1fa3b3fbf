"""Hierarchies minted from nested names, and sites placed by a chain of names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import slugify


def mint(rows: DataFrame, levels: list[str]) -> DataFrame:
    """(id, part_of, name, level): one unit for every distinct prefix of names, its id the slugs of the path.

    A row's path ends at its first empty name.
    """
    parts = []
    for k in range(len(levels)):
        own = [slugify(F.col(c)) for c in levels[: k + 1]]
        filled = reduce(lambda a, b: a & b, [F.coalesce(F.col(c), F.lit("")) != "" for c in levels[: k + 1]])
        parent = F.concat_ws("-", *own[:-1]) if k else F.lit(None).cast("string")
        parts.append(rows.where(filled).select(F.concat_ws("-", *own).alias("id"), parent.alias("part_of"), F.col(levels[k]).alias("name"), F.lit(k).alias("level")).distinct())
    return reduce(DataFrame.unionByName, parts)


def collisions(units: DataFrame) -> DataFrame:
    """Ids that stand for more than one path or name."""
    return units.groupBy("id").agg(F.count("*").alias("n")).where("n > 1")


def chain_lookup(rows: DataFrame, admins: DataFrame, columns: list[str]) -> DataFrame:
    """Adds parent: the deepest unit reached by the slugs of the columns' names (or aliases) below one another, stopping
    at the first miss, and misses (the number of the column that failed, null if none). With a single root that the
    first column does not name, the chain starts below it."""
    names = admins.select("id", "part_of", F.explode(F.array_distinct(F.transform(F.array_append(F.coalesce("alias", F.array().cast("array<string>")), F.col("name")), slugify))).alias("slug"))
    table = names.where("slug <> ''").groupBy("part_of", "slug").agg(F.min("id").alias("_id"))
    out = rows.withColumns({"parent": F.lit(None).cast("string"), "_open": F.lit(True), "misses": F.lit(None).cast("int")})
    roots = admins.where("part_of is null").select("id", "name").limit(2).collect()  # two rows at most
    if len(roots) == 1:
        out = out.withColumn("parent", F.lit(roots[0]["id"]))
    for k, c in enumerate(columns):
        slug = slugify(F.coalesce(F.col(c), F.lit("")))
        found = table.select(F.col("part_of").alias("_up"), F.col("slug").alias("_slug"), "_id")
        # only open rows look on; a closed row's key is null
        key = F.when(F.col("_open") & (slug != ""), slug)
        out = out.withColumn("_key", key).join(found, (F.col("_key") == F.col("_slug")) & F.col("parent").eqNullSafe(F.col("_up")), "left")
        miss = F.col("_open") & F.col("_id").isNull() & (slug != "")
        if k == 0 and len(roots) == 1:
            miss = miss & (F.col("_key") != slugify(F.lit(roots[0]["name"])))
        out = out.withColumns({"parent": F.coalesce("_id", "parent"), "misses": F.when(miss & F.col("misses").isNull(), k).otherwise(F.col("misses")), "_open": F.col("_open") & ~miss}).drop("_id", "_up", "_slug", "_key")
    return out.drop("_open")
