"""Snapshot merge, high-water marks and comparison of two runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import instant_key


def last_of_each(rows: DataFrame, key: str = "id", order: str = "seq") -> DataFrame:
    """The last row of each key in file order, combined on the map side."""
    rest = [c for c in rows.columns if c not in (key, order)]
    return rows.groupBy(key).agg(F.max_by(F.struct(order, *rest), order).alias("r")).select(key, "r.*")


def upsert(old: DataFrame, incoming: DataFrame, full: bool = False, key: str = "id", order: str = "seq") -> DataFrame:
    """Old rows whose key does not come in (all of them, repeated and keyless ones too, in their order), then the last
    incoming row of each key. Adds source (0 old, 1 incoming), which with the order column restores the file's order."""
    new = last_of_each(incoming.where(F.col(key).isNotNull()), key, order).select(*incoming.columns).withColumn("source", F.lit(1))
    if full:
        return new
    kept = old.join(new.select(F.col(key).alias("_k")), F.col(key) == F.col("_k"), "left_anti").withColumn("source", F.lit(0))
    return kept.unionByName(new)


def merge_stats(old: DataFrame, incoming: DataFrame, key: str = "id") -> DataFrame:
    """One row: total, added and updated of an upsert."""
    known = old.select(F.col(key).alias("_k"), F.lit(True).alias("known")).distinct()
    new = incoming.where(F.col(key).isNotNull()).select(key).distinct().join(known, F.col(key) == F.col("_k"), "left")
    counts = new.agg(F.count_if(F.col("known").isNull()).alias("added"), F.count_if(F.col("known").isNotNull()).alias("updated"))
    return upsert(old, incoming, key=key).agg(F.count("*").alias("total")).crossJoin(counts)  # two single rows


def watermark(rows: DataFrame, time: str, order: str = "seq") -> DataFrame:
    """One row: the text of the latest instant; malformed ones lose, of equal instants the first text stays."""
    return rows.select(F.col(time).alias("t"), instant_key(F.col(time)).alias("k"), order).where("k is not null").agg(F.max_by("t", F.struct("k", -F.col(order))).alias("watermark"))


def compare_runs(now: DataFrame, before: DataFrame, in_scope: list[str], key: str = "id", content: str = "hash") -> DataFrame:
    """(id, change): new, changed, unchanged, removed (of the scope's columns' values in this run) or kept."""
    a = now.select(F.col(key).alias("id"), F.col(content).alias("_a"))
    b = before.select(F.col(key).alias("_id"), F.col(content).alias("_b"), *in_scope)
    both = a.join(b, F.col("id") == F.col("_id"), "full_outer")
    scoped = F.lit(True)
    for c in in_scope:
        values = now.select(F.col(c).alias(f"_s_{c}")).distinct()
        both = both.join(values, F.col(c) == F.col(f"_s_{c}"), "left")
        scoped = scoped & F.col(f"_s_{c}").isNotNull()
    change = F.when(F.col("_id").isNull(), "new").when(F.col("id").isNull(), F.when(scoped, "removed").otherwise("kept")).when(F.col("_a").eqNullSafe(F.col("_b")), "unchanged").otherwise("changed")
    return both.select(F.coalesce("id", "_id").alias("id"), change.alias("change"))
