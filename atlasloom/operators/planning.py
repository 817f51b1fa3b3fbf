"""Units of work for requests of bounded size, and group membership of units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.periods import period_kind


def _chunks(ids: DataFrame, size: int) -> DataFrame:
    """(chunk, ids): rows (id, place) in lists of at most `size`, by their places from 0."""
    rows = ids.groupBy(F.floor(F.col("place") / size).alias("chunk")).agg(F.array_sort(F.collect_list(F.struct("place", "id"))).alias("l"))
    return rows.select("chunk", F.transform("l", lambda x: x["id"]).alias("ids"))


def request_units(indicators: DataFrame, periods: DataFrame, levels: list[tuple[int, int]], chunk: int = 10, most_rows: int = 20_000, weights: DataFrame | None = None) -> DataFrame:
    """(level, chunk, group, batch, indicators, periods): one request each; ordered by these columns they are in plan order.

    indicators: id, place. periods: period, place; periods of one kind share batches, a relative period is asked for
    alone. levels: (level, units there), which the caller states; a batch holds as many periods as keep ids x periods x
    units within most_rows, at least one. weights (chunk, weight) replaces the number of ids by another, such as data elements.
    """
    lists = _chunks(indicators, chunk).withColumn("weight", F.size("ids").cast("long"))
    if weights is not None:
        lists = lists.drop("weight").join(weights, "chunk", "left").withColumn("weight", F.greatest(F.coalesce("weight", F.lit(1)), F.lit(1)).cast("long"))
    named = F.array(*[F.struct(F.lit(level).alias("level"), F.lit(n).cast("long").alias("units")) for level, n in levels])
    lists = lists.withColumn("l", F.explode(named)).select("chunk", "ids", "weight", "l.*")
    lists = lists.withColumn("size", F.greatest(F.floor(F.lit(most_rows) / (F.col("weight") * F.greatest("units", F.lit(1)))), F.lit(1)))
    kind = F.coalesce(period_kind(F.col("period")), F.concat(F.lit("alone:"), "period"))
    shaped = periods.withColumn("kind", kind)
    groups = shaped.groupBy("kind").agg(F.min("place").alias("group"), F.array_sort(F.collect_list(F.struct("place", "period"))).alias("l"))
    listed = groups.select("group", F.transform("l", lambda x: x["period"]).alias("all"))  # the periods that a run names
    sizes = lists.select("size").distinct().withColumn("k", F.lit(1)).join(listed.withColumn("k", F.lit(1)), "k")
    cut = sizes.select("size", "group", F.posexplode(F.transform(F.sequence(F.lit(0), F.ceil(F.size("all") / F.col("size")).cast("int") - 1), lambda b: F.slice("all", (b * F.col("size") + 1).cast("int"), F.col("size").cast("int")))).alias("batch", "periods"))
    return lists.join(cut, "size").select("level", "chunk", "group", "batch", F.col("ids").alias("indicators"), "periods")


def memberships(groups: DataFrame, sets: DataFrame | None = None) -> DataFrame:
    """(unit, groups): the groups of each unit without repeats, those of group sets before single ones, each by name order given.

    groups and sets: id, name, place, units (array).
    """
    def rows(frame: DataFrame, rank: int) -> DataFrame:
        return frame.select(F.explode("units").alias("unit"), F.struct(F.lit(rank).alias("rank"), "place", "id", "name").alias("g"))

    all_ = rows(groups, 1) if sets is None else rows(sets, 0).unionByName(rows(groups, 1))
    first = all_.groupBy("unit", F.col("g.id").alias("id")).agg(F.min("g").alias("g"))
    return first.groupBy("unit").agg(F.transform(F.array_sort(F.collect_list("g")), lambda g: F.struct(g["id"].alias("id"), g["name"].alias("name"))).alias("groups"))


def number_units(units: DataFrame) -> DataFrame:
    """Adds unit, the place of each request in plan order; a plan is as long as what one run asks for."""
    order: list[Column | str] = ["level", "chunk", "group", "batch"]
    return units.withColumn("unit", F.row_number().over(Window.orderBy(*order)) - 1)
