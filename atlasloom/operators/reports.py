"""The issue report and what is counted over retained rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MOST_ISSUES, SMALL_PARTITION, LISTED = 1000, 100, 1000


def duplicate_codes(rows: DataFrame, code: str = "pcode", listed: int = LISTED) -> DataFrame:
    """(pcode, ids, n) of codes that several retained rows carry; the ids sorted and joined, the first `listed` of them with the number of the others.

    The ids of a code are cut to the listed ones before they are shuffled and gathered, however many rows carry it.
    """
    held = rows.where(F.col(code).isNotNull()).select(F.col(code), "id")
    counts = held.groupBy(code).agg(F.count("*").alias("n")).where("n > 1")
    first = held.withColumn("_nth", F.row_number().over(Window.partitionBy(code).orderBy("id"))).where(F.col("_nth") <= listed)
    ids = first.groupBy(code).agg(F.array_join(F.array_sort(F.collect_list("id")), ", ").alias("ids"))
    more = F.when(F.col("n") > listed, F.concat(F.lit(" and "), F.col("n") - listed, F.lit(" more"))).otherwise("")
    return counts.join(ids, code).select(code, F.concat("ids", more).alias("ids"), "n")


def issue_counts(issues: DataFrame) -> DataFrame:
    return issues.groupBy("kind").agg(F.count("*").alias("n"))


def capped_issues(issues: DataFrame, most: int = MOST_ISSUES, order: str | list[str] = "seq") -> DataFrame:
    """At most so many issues of each kind, in the order of arrival. The window's limit is applied before the shuffle too."""
    by = [order] if isinstance(order, str) else order
    return issues.withColumn("nth", F.row_number().over(Window.partitionBy("kind").orderBy(*by))).where(F.col("nth") <= most)


def with_organizations(locations: DataFrame, organizations: DataFrame) -> DataFrame:
    """locations with _o, the id of their organization if there is one, and its other columns under a leading underscore."""
    rest = [F.col(c).alias(f"_{c}") for c in organizations.columns if c != "id"]
    return locations.join(organizations.select(F.col("id").alias("_o"), *rest), F.col("managing_organization") == F.col("_o"), "left")


def small_partitions(rows: DataFrame, keys: list[str], least: int = SMALL_PARTITION) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") < least)


def bounds(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Bounding box, rows and rows without a place of each group."""
    return rows.groupBy(*keys).agg(F.min("lon").alias("xmin"), F.min("lat").alias("ymin"), F.max("lon").alias("xmax"), F.max("lat").alias("ymax"), F.count("*").alias("n"), F.count_if(F.col("lon").isNull()).alias("n_without"))


def organization_issues(locations: DataFrame, organizations: DataFrame) -> DataFrame:
    """(kind, location_id): organizations that are missing, or whose name (if any) differs from the place's."""
    joined = with_organizations(locations.where("managing_organization is not null"), organizations.select("id", "name"))
    kind = F.when(F.col("_o").isNull(), "organization_missing").when(F.col("_name") != F.col("name"), "organization_name_mismatch")
    return joined.select(kind.alias("kind"), F.col("id").alias("location_id")).where("kind is not null")


def output_order(rows: DataFrame, keys: list[str], order: str = "hilbert", tie: str = "seq") -> DataFrame:
    """Adds place, from 1 within each partition: rows with a geometry along the curve, ties in file order."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_last(), tie)))


def in_envelope(rows: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    """Rows whose bounding box (or place) meets an envelope, as plain comparisons that reach a Parquet scan."""
    if "bbox" in rows.columns:
        return rows.where((F.col("bbox.xmin") <= xmax) & (F.col("bbox.xmax") >= xmin) & (F.col("bbox.ymin") <= ymax) & (F.col("bbox.ymax") >= ymin))
    return rows.where(F.col("lon").between(xmin, xmax) & F.col("lat").between(ymin, ymax))
