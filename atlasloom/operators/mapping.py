"""A statistics server's units and items met with the registry's places, and what is counted over a run's reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.naming import Instance

_PLACE = "struct<resourceType:string,id:string,name:string,identifier:array<struct<system:string,value:string>>,partOf:struct<reference:string>>"


def _places(lines: DataFrame) -> DataFrame:
    return lines.select("seq", F.from_json("text", _PLACE).alias("p")).where("p.resourceType = 'Location' and p.id is not null").select("seq", "p.*")


def unit_mapping(lines: DataFrame, system: str) -> DataFrame:
    """(unit, location, name): the place that carries each unit as an identifier of a system; the last line counts."""
    held = _places(lines).select("seq", "id", "name", F.posexplode("identifier").alias("nth", "i")).where((F.col("i.system") == system) & F.col("i.value").isNotNull())
    return held.groupBy(F.col("i.value").alias("unit")).agg(F.max_by(F.struct("id", "name"), F.struct("seq", "nth")).alias("p")).select("unit", F.col("p.id").alias("location"), F.col("p.name").alias("name"))


def unit_parents(lines: DataFrame, system: str) -> DataFrame:
    """(unit, parent): each unit's parent unit, by the parts of the places that carry them; null where the parent carries none."""
    first = F.get(F.filter("identifier", lambda i: i["system"] == system), F.lit(0))["value"]
    held = _places(lines).select("seq", "id", first.alias("unit"), F.substring_index("partOf.reference", "/", -1).alias("up")).where("unit is not null")
    named = held.groupBy(F.col("id").alias("_id")).agg(F.max_by("unit", "seq").alias("parent"))
    last = held.groupBy("unit").agg(F.max_by("up", "seq").alias("up"))
    return last.join(named, F.col("up") == F.col("_id"), "left").select("unit", "parent")


def placed_units(parents: DataFrame, levels: DataFrame) -> DataFrame:
    """(unit, level, level_unit): every unit with itself and its ancestors at the requested levels. levels: level, level_unit."""
    from .hierarchy import resolve

    nothing = [F.lit(None).cast("string").alias(c) for c in ("type", "name", "pcode")]
    found = resolve(parents.select(F.col("unit").alias("id"), F.col("parent").alias("part_of"), *nothing, F.lit(0).alias("seq")))
    line = found.where("dropped is null").select(F.col("id").alias("unit"), F.explode(F.array_append(F.transform("chain", lambda n: n["id"]), F.col("id"))).alias("level_unit"))
    return line.join(levels, "level_unit").select("unit", "level", "level_unit")


def matched(rows: DataFrame, items: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with location and location_name; issues) of values (dx, ou, ...): unexpected_indicator for an item that was not
    asked for, and unmapped_org_unit, once a unit, for one that no place carries. items: id. The rest is left out."""
    known = rows.join(items.select(F.col("id").alias("_item")).distinct(), F.col("dx") == F.col("_item"), "left")
    met = known.join(mapping.select(F.col("unit").alias("_unit"), "location", F.col("name").alias("location_name")), F.col("ou") == F.col("_unit"), "left")
    odd = met.where("_item is null").select(F.lit("unexpected_indicator").alias("kind"), F.col("dx").alias("location_id"), F.lit("not asked for").alias("detail"))
    lost = met.where("_item is not null and _unit is null").select("ou").distinct().select(F.lit("unmapped_org_unit").alias("kind"), F.col("ou").alias("location_id"), F.lit("no place carries this unit").alias("detail"))
    return met.where("_item is not null and _unit is not null").drop("_item", "_unit"), odd.unionByName(lost)


def run_tallies(reports: DataFrame) -> DataFrame:
    """One row over reports (subject, period, stratifiers, change): what a run wrote, and how it compares with the one before."""
    changes = [F.count_if(F.col("change") == c).alias(c) for c in ("new", "changed", "unchanged")]
    return reports.agg(F.count("*").alias("written"), F.count_distinct("subject").alias("locations"), F.count_distinct("period").alias("periods"), F.coalesce(F.sum("stratifiers"), F.lit(0)).alias("stratified"), *changes)


def level_counts(units: DataFrame, facility_level: int) -> DataFrame:
    """(level, n, role) of the units of a tree."""
    role = F.when(F.col("level") < facility_level, "admin units").when(F.col("level") == facility_level, "facilities").otherwise("skipped")
    return units.groupBy("level").agg(F.count("*").alias("n")).withColumn("role", role)


def scoring_counts(items: DataFrame) -> DataFrame:
    """(scoring, n) of items (kind, scoring): data elements and reporting rates are counted by kind."""
    shown = F.when(F.col("kind") == "data element", "data element counts").when(F.col("kind") == "reporting rate", "reporting rates").otherwise(F.col("scoring"))
    return items.groupBy(shown.alias("scoring")).agg(F.count("*").alias("n"))


def topics(kind: Column, groups: Column, instance: Instance) -> Column:
    """One topic (system, code, display) a group; for a data element one for each group set that the group is in. groups: array of (id, name, sets)."""

    def coded(group: Column, system: Column) -> Column:
        return F.struct(F.when(group["id"].isNotNull(), system).alias("system"), group["id"].alias("code"), group["name"].alias("display"))

    def of(group: Column) -> Column:
        sets = F.transform(group["sets"], lambda s: coded(group, F.concat(F.lit(instance.group("data-element-group-set") + "/"), s)))
        plain = F.when(kind == "data element", instance.group("data-element-group")).otherwise(instance.group("indicator-group"))
        return F.when((kind == "data element") & (F.size(group["sets"]) > 0), sets).otherwise(F.array(coded(group, plain)))

    return F.flatten(F.transform(groups, of))


def changed_targets(values: DataFrame, targets: DataFrame) -> DataFrame:
    """(target): the targets that contain the period of a value that changed. values: start, end; targets: target, t_start, t_end.

    Periods are bounded by the calendar: each distinct one meets the targets that hold its first day.
    """
    spans = values.where("start is not null").select("start", "end").distinct()
    days = targets.select("target", "t_end", F.explode(F.sequence("t_start", "t_end")).alias("start"))
    return spans.join(days, "start").where("end <= t_end").select("target").distinct()


def missing_boundaries(units: DataFrame, facility_level: int) -> tuple[DataFrame, DataFrame]:
    """(units with the geometries of their children's union where they have none; issues). units: id, parent, level, geometry (WKB or null).

    Levels are filled from the deepest up, so that a filled unit can fill its parent; children are united in groups first.
    """
    from collections.abc import Iterator

    import pyarrow as pa

    from ..functions import geometry as geo
    from ..workspace import folder, written

    path = folder(units.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for parts in batch.column("parts").to_pylist():
                found = geo.union([g for g in map(geo.from_wkb, parts) if g[0] != "point"])
                out.append(geo.to_wkb(found) if found else None)
            yield pa.RecordBatch.from_arrays([batch.column("up"), pa.array(out, pa.binary()), batch.column("n")], names=["up", "filled", "n"])

    now, issues = units, None
    most = units.agg(F.max("level")).first()[0]
    for level in range(min(most or 0, facility_level) - 1, -1, -1):
        open_ = now.where((F.col("level") == level) & F.col("geometry").isNull()).select(F.col("id").alias("up"))
        if not open_.limit(1).count():
            continue
        kids = now.where("geometry is not null").join(open_, F.col("parent") == F.col("up")).select("up", "id", "geometry")
        shares = kids.groupBy("up", F.pmod(F.xxhash64("id"), F.lit(16)).alias("share")).agg(F.collect_list("geometry").alias("parts"), F.count("*").alias("n"))
        some = shares.select("up", "parts", "n").mapInArrow(run, "up string, filled binary, n long").where("filled is not null")
        whole = some.groupBy("up").agg(F.collect_list("filled").alias("parts"), F.sum("n").alias("n")).mapInArrow(run, "up string, filled binary, n long").where("filled is not null")
        whole = written(whole, f"{path}/level{level}")
        found = whole.select(F.lit("boundary_from_children").alias("kind"), F.col("up").alias("location_id"), F.concat(F.lit("union of "), "n", F.lit(" children")).alias("detail"))
        issues = found if issues is None else issues.unionByName(found)
        now = now.join(whole.select("up", "filled"), F.col("id") == F.col("up"), "left").withColumn("geometry", F.coalesce("geometry", "filled")).drop("up", "filled")
        now = written(now, f"{path}/units{level}")
    none = units.sparkSession.createDataFrame([], "kind string, location_id string, detail string")
    return now, none if issues is None else issues
