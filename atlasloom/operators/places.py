"""Places: one Python pass from document lines to flat rows with geometry; the joins that follow are Spark's."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions import geometry as geo
from ..functions.cells import hilbert_keys
from ..functions.documents import Profile, parse_location, parse_organization
from ..workspace import written
from . import hierarchy
from .reports import duplicate_codes

# The columns of the dataset's layout.
_TEXT = "version_id last_updated name status description type physical_type part_of managing_organization pcode gers_id settlement_type delivery_strategy facility_level ownership".split()
_IDENTIFIER = "array<struct<system:string,value:string>>"
_ISSUES = "array<struct<kind:string,location_id:string,detail:string>>"
_PLACE = f"id string, {', '.join(f'{c} string' for c in _TEXT)}, alias array<string>, identifier {_IDENTIFIER}, position_longitude double, position_latitude double, overlays_admin_unit_ids array<string>, cells array<struct<scheme:string,level:int,cell:string>>, boundary_url string, geom_type string, lon double, lat double, geometry binary, bbox struct<xmin:double,ymin:double,xmax:double,ymax:double>, hilbert long, fhir_json string, issues {_ISSUES}"
_ORGANIZATION = f"id string, name string, version_id string, last_updated string, identifier {_IDENTIFIER}, nhfr_code string, nhfr_uid string, facility_level string, ownership string, facility_level_text string, ownership_text string, fhir_json string, issues {_ISSUES}"


def _shape(record: dict, issues: list[dict]) -> dict:
    """The geometry columns of a parsed place: its boundary, else its position, else nothing."""
    key, boundary = record["id"], record.pop("boundary", None)
    position = (record["position_longitude"], record["position_latitude"]) if "position_longitude" in record else None

    def say(kind: str, detail: str) -> None:
        issues.append({"kind": kind, "location_id": key, "detail": detail})

    shape = None
    names = ("xmin", "ymin", "xmax", "ymax")
    if boundary is None and position is not None and not record.get("boundary_url"):
        x, y = position
        return record | {"geom_type": "point", "lon": x, "lat": y, "geometry": geo.to_wkb(("point", position)), "bbox": dict(zip(names, (x, y, x, y), strict=True))}
    if boundary is not None:
        shape, found = geo.parse_boundary(boundary)
        for kind, detail in found:
            say(kind, detail)
    elif record.get("boundary_url"):
        say("boundary_unresolved_url", record["boundary_url"])
    if shape is not None and shape[0] not in ("point", "polygon", "multipolygon"):
        say("geometry_unexpected_type", f"unsupported type {shape[0]}")
        return record
    if shape is None and position is not None:
        shape = ("point", position)
    if shape is None:
        say("no_geometry", "no position and no usable boundary")
        return record
    if (box := geo.bbox(shape)) is None:
        say("geometry_empty", "empty geometry")
        return record
    if shape[0] != "point" and (reason := geo.invalid(shape)):
        say("geometry_invalid", f"{reason}; written as is")
    if position is not None and not geo.intersects(shape, *position)[0]:
        say("position_outside_boundary", f"position {position} falls outside the Location's own boundary")
    if (point := position or geo.interior_point(shape)) is None:
        say("geometry_no_interior_point", "no interior point could be computed for a non-empty geometry")
        return record
    return record | {"geom_type": "point" if shape[0] == "point" else "polygon", "lon": point[0], "lat": point[1], "geometry": geo.to_wkb(shape), "bbox": dict(zip(names, box, strict=True))}


def _parsed(lines: DataFrame, columns: str, read) -> DataFrame:
    schema = T.StructType([T.StructField("seq", lines.schema["seq"].dataType), *T._parse_datatype_string(columns).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, nothing = arrow.names[1:-1], {}
        for batch in batches:
            columns, issues = {c: [] for c in names}, []
            put = [(c, column.append) for c, column in columns.items()]
            for text in batch.column("text").to_pylist():
                record, found = read(text)
                get = (record or nothing).get
                for c, append in put:
                    append(get(c))
                issues.append(found)
            if "hilbert" in columns:
                columns["hilbert"] = hilbert_keys([b and (b["xmin"] + b["xmax"]) / 2 for b in columns["bbox"]], [b and (b["ymin"] + b["ymax"]) / 2 for b in columns["bbox"]])
            body = [pa.array(columns[c], arrow.field(c).type) for c in names]
            yield pa.RecordBatch.from_arrays([batch.column("seq"), *body, pa.array(issues, arrow.field("issues").type)], names=arrow.names)

    return lines.select("seq", "text").mapInArrow(run, schema)


def flatten(lines: DataFrame, profile: Profile | None = None) -> DataFrame:
    """A row per line: seq, the flat record (id null if the line is unusable) and its issues."""
    own = profile or Profile()

    def read(text: str) -> tuple[dict | None, list[dict]]:
        record, issues = parse_location(text, own)
        return (_shape(record, issues) if record else None), issues

    return _parsed(lines, _PLACE, read)


def flatten_organizations(lines: DataFrame, profile: Profile | None = None) -> DataFrame:
    own = profile or Profile()
    return _parsed(lines, _ORGANIZATION, lambda text: parse_organization(text, own))


def located(flat: DataFrame, country: str | None = None, keep_without_geometry: bool = False, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(retained rows with hierarchy, country, tier and Hilbert key; issues with the seq of their record) of flattened places.

    With a path the rows are written there, and the issues that they tell are read from there.
    """
    records = flat.where("id is not null")
    narrow = records.select("id", "part_of", "type", "name", "pcode", "seq")
    resolved = hierarchy.resolve(narrow)
    levels = hierarchy.with_country(hierarchy.with_levels(resolved.where("dropped is null")), country)
    keep = ["depth", "ancestor_ids", "path", "admin_level", "first_pcode", *[f"admin{k}_{c}" for k in range(hierarchy.ADMIN_COLUMNS) for c in ("name", "code")], "tier", "country"]
    own = levels.select(F.col("id").alias("_id"), F.col("seq").alias("_seq"), "chain", *keep)
    rows = records.drop("issues").join(own, (F.col("id") == F.col("_id")) & (F.col("seq") == F.col("_seq"))).drop("_id", "_seq")
    if not keep_without_geometry:
        rows = rows.where("geom_type is not null")
    deepest = F.get(F.reverse(F.array_sort(F.transform(F.filter("cells", lambda c: c["scheme"] == "quadkey"), lambda c, i: F.struct(c["level"], i, c["cell"].alias("cell"))))), F.lit(0))
    rows = rows.withColumns({"quadkey": F.when(F.col("geom_type").isNotNull(), deepest["cell"]), "quadkey_level": F.when(F.col("geom_type").isNotNull(), deepest["level"])})
    rows = written(rows, path) if path else rows
    issues = flat.where(F.size("issues") > 0).select("seq", F.explode("issues").alias("i")).select("i.*", "seq").unionByName(hierarchy.hierarchy_issues(narrow, resolved))
    unknown = rows.where("country = 'unknown'").select(F.lit("no_country").alias("kind"), F.col("id").alias("location_id"), F.lit("no administrative root with a code").alias("detail"), "seq")
    twice = duplicate_codes(rows).select(F.lit("duplicate_pcode").alias("kind"), F.col("pcode").alias("location_id"), F.col("ids").alias("detail"))
    return rows, issues.unionByName(unknown).unionByName(twice, allowMissingColumns=True)


def with_organizations(rows: DataFrame, organizations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with their organization's columns; issues). Of repeated organizations the first counts."""
    first = hierarchy.first_of_each(organizations.where("id is not null"))
    own = first.select(F.col("id").alias("_o"), F.col("name").alias("_name"), "nhfr_code", "nhfr_uid", F.col("identifier").alias("organization_identifier"), "facility_level_text", "ownership_text", F.col("fhir_json").alias("organization_json"))
    joined = rows.join(own, F.col("managing_organization") == F.col("_o"), "left")
    kind = F.when(F.col("managing_organization").isNotNull() & F.col("_o").isNull(), "organization_missing").when(F.col("_name") != F.col("name"), "organization_name_mismatch")
    issues = joined.select(kind.alias("kind"), F.col("id").alias("location_id"), F.col("managing_organization").alias("detail"), "seq").where("kind is not null")
    return joined.drop("_o", "_name"), issues


CHUNK = 10_000


def outside_parent(rows: DataFrame) -> DataFrame:
    """(kind, location_id, detail) of places whose point lies outside their nearest ancestor with a polygon.

    Places below one parent have one such ancestor, so it is looked for once a parent. Points travel to their polygon in
    chunks of about CHUNK, several for a polygon with many, so each polygon is decoded once per chunk and no task
    gathers all points of one polygon.
    """
    polygons = rows.where("geom_type = 'polygon'").select(F.col("id").alias("polygon"), F.col("geometry").alias("wkb"))
    line = F.array_join(F.transform("chain", lambda n: n["id"]), "\x01")  # a text, so that equal ones are found by hashing
    parents = rows.where("lon is not null and size(chain) > 0").select(line.alias("line")).distinct()
    parents = parents.select(F.substring_index("line", "\x01", 1).alias("up"), F.posexplode(F.split("line", "\x01")).alias("far", "polygon")).join(polygons.select("polygon"), "polygon", "left_semi")
    parents = parents.groupBy("up").agg(F.min(F.struct("far", "polygon"))["polygon"].alias("polygon"))
    near = rows.where("lon is not null and size(chain) > 0").select("id", "lon", "lat", F.get("chain", F.lit(0))["id"].alias("up")).join(parents, "up").drop("up")
    sizes = near.groupBy("polygon").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    dealt = near.join(sizes, "polygon").withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")))
    chunks = dealt.groupBy("polygon", "chunk").agg(F.collect_list(F.struct("id", "lon", "lat")).alias("points"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, points, wkb in zip(batch.column("polygon").to_pylist(), batch.column("points"), batch.column("wkb").to_pylist(), strict=True):
                x, y = (points.values.field(c).to_numpy() for c in ("lon", "lat"))
                out = points.values.field("id").filter(pa.array(~geo.intersects(geo.from_wkb(wkb), x, y))).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array(["point_outside_parent"] * len(out), pa.string()), pa.array(out, pa.string()), pa.array([f"outside {name}"] * len(out), pa.string())], names=["kind", "location_id", "detail"])

    return chunks.join(polygons, "polygon").mapInArrow(run, "kind string, location_id string, detail string")


def boundary_from_payload(payload: bytes) -> bytes:
    """The bytes of a fetched boundary: the data of a Binary resource, else the payload itself."""
    import base64

    if payload[:1] == b"{" and b'"Binary"' in payload:
        value = json.loads(payload)
        if value.get("resourceType") == "Binary":
            return base64.b64decode("".join(str(value.get("data", "")).split()))
    return payload
