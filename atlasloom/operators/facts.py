"""Aggregation of period-based facts over the levels of a hierarchy, indicators and their strata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import Item, evaluate, items, parse


def to_targets(values: DataFrame, targets: DataFrame) -> DataFrame:
    """Each value with the first target period (lowest `place`) that contains its own; others have a null target and,
    if they overlap one, the issue straddling_period.

    targets: target, place, t_start, t_end; a run asks for a bounded list of periods, so values are first reduced
    to their distinct periods (bounded by the calendar), matched by days, and joined back on the period.
    """
    own = values.select("start", "end").distinct()
    days = own.select("start", "end", F.explode(F.sequence("start", "end")).alias("day"))
    t = targets.select("target", "place", "t_start", "t_end", F.explode(F.sequence("t_start", "t_end")).alias("day"))
    met = days.join(t, "day").groupBy("start", "end", "target", "place", "t_start", "t_end").agg(F.count("*").alias("_n"))
    inside = (F.col("t_start") <= F.col("start")) & (F.col("end") <= F.col("t_end"))
    best = met.groupBy("start", "end").agg(F.min(F.when(inside, F.struct("place", "target"))).alias("b")).select(F.col("start").alias("_s"), F.col("end").alias("_e"), F.col("b.target").alias("target"), F.when(F.col("b").isNull(), "straddling_period").alias("issue"))
    return values.join(best, (F.col("start") == F.col("_s")) & (F.col("end") == F.col("_e")), "left").drop("_s", "_e")


def by_unit(values: DataFrame, average: list[str]) -> DataFrame:
    """First stage: one value per (target, unit, element, option, attribute): the sum, or for `average` elements sum / count."""
    sums = values.where("target is not null").groupBy("target", "unit", "element", "option", "attribute").agg(F.sum("value").alias("s"), F.count("value").alias("n"))
    return sums.select("target", "unit", "element", "option", "attribute", F.when(F.col("element").isin(average), F.col("s") / F.col("n")).otherwise(F.col("s")).alias("value"))


def by_level(unit_values: DataFrame, above: DataFrame) -> DataFrame:
    """Second stage: sums over the units below each level unit. above: unit, level_unit, level (a unit is above itself)."""
    placed = unit_values.join(above, "unit")
    return placed.groupBy("target", "level", "level_unit", "element", "option", "attribute").agg(F.sum("value").alias("value"))


def item_sum(item: Item) -> Column:
    """The sum over an item's options and attributes; null if there is no value."""
    hit = F.col("element") == item.element
    if item.option:
        hit = hit & (F.col("option") == item.option)
    if item.attribute:
        hit = hit & (F.col("attribute") == item.attribute)
    return F.sum(F.when(hit, F.col("value")))


def indicator(level_values: DataFrame, numerator: str, denominator: str, factor: float = 1.0, annual: Column | None = None, constants: dict[str, float] | None = None, keys: tuple[str, ...] = ("target", "level", "level_unit")) -> DataFrame:
    """Numerator, denominator and value (factor x numerator / denominator, times `annual`) of each group.

    A null numerator or denominator, or a denominator of 0, gives no row.
    """
    up, down = parse(numerator), parse(denominator)
    own = list(dict.fromkeys(items(up) + items(down)))
    wide = level_values.groupBy(*keys).agg(*[item_sum(i).alias(f"_i{k}") for k, i in enumerate(own)])
    columns = {i: F.col(f"_i{k}") for k, i in enumerate(own)}
    out = wide.withColumns({"numerator": evaluate(up, columns, constants), "denominator": evaluate(down, columns, constants)})
    value = F.col("numerator") / F.col("denominator") * F.lit(factor)
    return out.where("numerator is not null and denominator is not null and denominator <> 0").select(*keys, "numerator", "denominator", (value * annual if annual is not None else value).alias("value"))


def with_strata(totals: DataFrame, strata: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(totals with their strata as text, sorted; strata without a total). strata: keys, label, value (text)."""
    lines = strata.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "label", "value"))), ";").alias("strata"))
    return totals.join(lines, keys, "left"), strata.join(totals.select(*keys), keys, "left_anti")
