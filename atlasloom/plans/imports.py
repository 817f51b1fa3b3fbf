"""The import dataflows: units from boundary features, sites from rows; and extract followed by transform."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions.documents import Profile
from ..operators import imports
from ..operators.order import write_text
from ..sources import files
from ..workspace import folder, written
from . import dataflows


def _pair(text: str, what: str) -> tuple[str, str]:
    left, sign, right = text.partition("=")
    if not sign or not left or not right:
        raise ValueError(f"{what} is A=B: {text}")
    return left, right


def run(spark: SparkSession, server: str, snapshot: str, out: str, **more: object) -> dict:
    """extract, then transform of what the snapshot then holds."""
    own = {k: more.pop(k) for k in ("country", "row_group_size", "partition_by", "keep_without_geometry") if k in more}
    pulled = dataflows.extract(spark, server, snapshot, **more)
    return {"extract": pulled, "transform": dataflows.transform(spark, snapshot, out, **own)}


def bake(spark: SparkSession, given: str, country: str, levels: list[str], out: str, alias: list[str] | None = None, system: str | None = None, dissolve: bool = False, profile: Profile | None = None) -> dict:
    """A FeatureCollection of leaf boundaries as a registry's units. country: NAME=CODE; levels: LEVEL=PROPERTY or LEVEL=PROPERTY:CODE, from the top."""
    head = spark.read.text(given, wholetext=True).select(F.get_json_object("value", "$.crs").alias("crs"), F.get_json_object("value", "$.type").alias("type")).first()
    if head["type"] != "FeatureCollection":
        raise ValueError("the input is no FeatureCollection")
    imports.check_crs({"crs": json.loads(head["crs"])} if head["crs"] else {})
    shaped = []
    for text in levels:
        name, title = _pair(text, "a level")
        title, _, code = title.partition(":")
        shaped.append((name, title, code or None))
    units, issues = imports.baked_units(written(files.read_features(spark, given), f"{folder(spark)}/features"), _pair(country, "the country"), shaped, system, dict(_pair(a, "an alias") for a in alias or []), dissolve, profile)
    n = write_text(written(units, f"{folder(spark)}/units"), out, ["level", "seq", "id"], "json")
    return dataflows.report_of(issues, written=n)


def bake_points(spark: SparkSession, given: str, admins: str, kind: str, out: str, id_col: str = "id", name_col: str = "name", lat_col: str = "lat", lon_col: str = "lon", parent: list[str] | None = None, identifier: list[str] | None = None, where: list[str] | None = None, cells: list[str] | None = None, types: list[str] | None = None, paired: bool = False, profile: Profile | None = None) -> dict:
    """Rows of a CSV file as sites below the units of a registry. parent: columns from the top; identifier and types: SYSTEM=COLUMN; where: COLUMN=VALUE."""
    from ..functions.cells import parse_cell_argument

    shape = "struct<id:string,name:string,alias:array<string>,partOf:struct<reference:string>>"
    held = files.read_lines(spark, admins).select(F.from_json("text", shape).alias("d")).where("d.id is not null and d.name is not null")
    known = written(held.select("d.id", F.substring_index("d.partOf.reference", "/", -1).alias("up"), "d.name", "d.alias"), f"{folder(spark)}/admins")
    known = known.join(known.select(F.col("id").alias("part_of")).distinct(), F.col("up") == F.col("part_of"), "left").drop("up")

    def pairs(items: list[str] | None, what: str) -> dict[str, str]:
        return {t.rpartition("=")[0]: t.rpartition("=")[2] for t in items or [] if _pair(t, what)}

    docs, issues = imports.baked_points(files.read_rows(spark, given), known, kind, {"id": id_col, "name": name_col, "lat": lat_col, "lon": lon_col}, parent or [], pairs(identifier, "an identifier"), dict(_pair(w, "a condition") for w in where or []), paired, [parse_cell_argument(c) for c in cells or []], pairs(types, "a type"), profile)
    n = write_text(written(docs, f"{folder(spark)}/sites"), out, ["seq", "place"], "json")
    return dataflows.report_of(issues, written=n)
