"""Registries made from files: units from nested names of boundary features, sites from rows with the names of their units."""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions.documents import GEOJSON, Profile, dumps
from ..functions.scalars import alias_list, is_fhir_id, slugify
from ..workspace import folder, written
from . import bake, mapping

WGS84 = ("EPSG:4326", "urn:ogc:def:crs:EPSG::4326", "urn:ogc:def:crs:OGC:1.3:CRS84", "CRS84", "OGC:CRS84")  # fixed values: the names of longitude and latitude
#: Stands for an empty name, which no unit has.
NOTHING = "(no name)"


def check_crs(collection: dict) -> None:
    """An error unless a FeatureCollection is in longitude and latitude, by name or by default."""
    crs = collection.get("crs")
    name = ((crs.get("properties") or {}).get("name") if isinstance(crs, dict) else None) if crs is not None else WGS84[0]
    if name not in WGS84:
        raise ValueError(f"coordinates in {name} must be turned into longitude and latitude first")


def _cell(column: str, name: str | None) -> Column:
    """A property's text, trimmed; null if it is empty."""
    if not name:
        return F.lit(None).cast("string")
    key = name.replace("'", "\\'")
    return F.nullif(F.trim(F.get_json_object(column, f"$['{key}']")), F.lit(""))


def _coded(system: str, code: Column | str) -> Column:
    return F.struct(F.array(F.struct(F.lit(system).alias("system"), (F.lit(code) if isinstance(code, str) else code).alias("code"))).alias("coding"))


def shapes(features: DataFrame) -> DataFrame:
    """(seq, wkb, issue) of GeoJSON geometries `geometry`: polygons with shells counter-clockwise, or why there is none."""

    def read(text: str | None) -> tuple[bytes | None, str | None]:
        if not text:
            return None, "geometry_invalid"
        try:
            found, _ = geo.from_geojson(json.loads(text))
        except ValueError:
            return None, "geometry_unparseable"
        if found[0] not in ("polygon", "multipolygon") or geo.bbox(found) is None:
            return None, "geometry_unexpected_type"
        if geo.invalid(found):
            mended = geo.repaired(found)
            return (geo.to_wkb(geo.oriented(mended)), "geometry_repaired") if mended else (None, "geometry_invalid")
        return geo.to_wkb(geo.oriented(found)), None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [read(t) for t in batch.column("geometry").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("seq"), pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.string())], names=["seq", "wkb", "issue"])

    return features.select("seq", "geometry").mapInArrow(run, f"seq {features.schema['seq'].dataType.simpleString()}, wkb binary, issue string")


def _attached(units: DataFrame, profile: Profile) -> DataFrame:
    """units with boundary, the base64 of the GeoJSON of `geometry` (WKB)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [w and base64.b64encode(dumps(geo.to_geojson(geo.from_wkb(w))).encode()).decode() for w in batch.column("geometry").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.string())], names=["_id", "boundary"])

    held = units.where("geometry is not null").select("id", "geometry").mapInArrow(run, "_id string, boundary string")
    return units.join(held, F.col("id") == F.col("_id"), "left").drop("_id")


def baked_units(features: DataFrame, country: tuple[str, str], levels: list[tuple[str, str, str | None]], system: str | None = None, aliases: dict[str, str] | None = None, dissolve: bool = False, profile: Profile | None = None) -> tuple[DataFrame, DataFrame]:
    """((level, seq, id, part_of, name, json); issues) of one-level features (seq, properties, geometry).

    country: name and code of the root. levels: name, property of the name and of the code, from the top. A unit's id is the slugs of
    its path, each of a code if there is one; the first feature of a unit counts. Two names with one id, a leaf that occurs twice
    and a property that is empty everywhere are errors. With dissolve the upper units get the union of what lies below them.
    """
    own, aliases = profile or Profile(), aliases or {}
    system, path = system or own.identifier("pcode"), folder(features.sparkSession)
    root = features.sparkSession.range(1).select(slugify(F.lit(country[1]))).first()[0]  # one value
    rows = features.select("seq", "geometry", *[f.alias(f"{c}{k}") for k, (name, title, code) in enumerate(levels) for c, f in (("name", _cell("properties", title)), ("code", _cell("properties", code)), ("alias", _cell("properties", aliases.get(name))))])
    last = len(levels) - 1
    rows = rows.withColumns({f"slug{k}": slugify(F.coalesce(f"code{k}", f"name{k}")) for k in range(last + 1)})
    rows = written(rows, f"{path}/named")
    filled = rows.agg(*[F.count(f"name{k}").alias(f"n{k}") for k in range(last + 1)]).first()
    for k, (name, title, _) in enumerate(levels):
        if not filled[f"n{k}"]:
            raise ValueError(f"level {name}: the property {title} is empty everywhere")
    whole = reduce(lambda a, b: a & b, [F.col(f"name{k}").isNotNull() & (F.coalesce(f"slug{k}", F.lit("")) != "") for k in range(last + 1)])
    missing = rows.where(~whole).select(F.lit("missing_field").alias("kind"), F.lit("<unknown>").alias("location_id"), F.concat_ws(" / ", *[f"name{k}" for k in range(last + 1)]).alias("detail"))

    def key(k: int) -> Column:
        return F.concat_ws("-", F.lit(root), *[f"slug{j}" for j in range(k + 1)])

    parts = [rows.where(whole).select(key(k).alias("id"), (key(k - 1) if k else F.lit(root)).alias("part_of"), F.col(f"name{k}").alias("name"), F.lit(k + 1).alias("level"), F.col(f"code{k}").alias("code"), F.col(f"alias{k}").alias("alias"), "seq") for k in range(last + 1)]
    named = written(reduce(DataFrame.unionByName, parts), f"{path}/parts")
    held = named.groupBy("id").agg(F.count_distinct("name").alias("names"), F.count("*").alias("n"), F.max("level").alias("level"))
    bad = held.where((F.col("names") > 1) | ((F.col("level") == last + 1) & (F.col("n") > 1))).orderBy("id").limit(3).collect()
    if bad:
        raise ValueError("; ".join(f"{r['id']} {'stands for several names' if r['names'] > 1 else 'occurs more than once'}" for r in bad))
    units = named.groupBy("id").agg(F.min_by(F.struct("part_of", "name", "level", "code", "alias", "seq"), "seq").alias("u")).select("id", "u.*")
    found = written(shapes(rows.where(whole)), f"{path}/shapes")
    units = units.join(found.select(F.col("seq").alias("_s"), "wkb"), (F.col("seq") == F.col("_s")) & (F.col("level") == last + 1), "left").drop("_s").withColumnRenamed("wkb", "geometry")
    top = features.sparkSession.createDataFrame([(root, None, country[0], 0, country[1], None)], "id string, part_of string, name string, level int, code string, alias string")
    units = written(units.unionByName(top, allowMissingColumns=True), f"{path}/units")
    issues = missing.unionByName(units.where(f"level = {last + 1}").join(found.where("issue is not null").select(F.col("seq").alias("_s"), "issue"), F.col("seq") == F.col("_s")).select(F.col("issue").alias("kind"), F.col("id").alias("location_id"), F.lit("boundary of the feature").alias("detail")))
    if dissolve:
        shaped, _ = mapping.missing_boundaries(units.select("id", F.col("part_of").alias("parent"), "level", "geometry"), last + 1)
        units = units.drop("geometry").join(shaped.select(F.col("id").alias("_i"), "geometry"), F.col("id") == F.col("_i")).drop("_i")
    units = _attached(units, own)
    boundary = F.when(F.col("boundary").isNotNull(), F.array(F.struct(F.lit(own.boundaries[0]).alias("url"), F.struct(F.lit(GEOJSON).alias("contentType"), F.col("boundary").alias("data")).alias("valueAttachment"))))
    alias = F.when(F.size(alias_list(F.col("alias"))) > 0, alias_list(F.col("alias")))
    doc = F.to_json(F.struct(
        F.lit("Location").alias("resourceType"), "id", "name", F.lit("active").alias("status"), F.array(_coded(own.codes("location-type"), "admin-unit")).alias("type"), _coded("http://terminology.hl7.org/CodeSystem/location-physical-type", "jdn").alias("physicalType"),
        F.array(F.struct(F.lit(system).alias("system"), F.coalesce("code", "id").alias("value"))).alias("identifier"), F.when(F.col("part_of").isNotNull(), F.struct(F.concat(F.lit("Location/"), "part_of").alias("reference"))).alias("partOf"), alias.alias("alias"), boundary.alias("extension"),
    ))
    return units.select("level", "seq", "id", "part_of", "name", doc.alias("json")), issues


def baked_points(rows: DataFrame, admins: DataFrame, kind: str, columns: dict[str, str], parents: list[str], identifiers: dict[str, str] | None = None, where: dict[str, str] | None = None, paired: bool = False, cells: list[tuple[str, int]] | None = None, types: dict[str, str] | None = None, profile: Profile | None = None) -> tuple[DataFrame, DataFrame]:
    """((seq, place, id, json); issues) of sites from rows of text: a place, and (paired) an organization before it.

    columns: the columns of id, name, lat and lon. parents: the columns that name the units above, from the top; admins: id, part_of,
    name, alias. identifiers and types: system to column. A row without a name or with a malformed id is left out; a repeated id is an
    error; coordinates that are no place cost the position alone.
    """
    own, path = profile or Profile(), folder(rows.sparkSession)
    for column, value in (where or {}).items():
        rows = rows.where(F.coalesce(column, F.lit("")) == value)
    text = {c: F.trim(F.coalesce(columns[c], F.lit(""))) for c in ("id", "name", "lat", "lon")}
    rest = {**{f"_i{k}": F.trim(F.coalesce(c, F.lit(""))) for k, c in enumerate((identifiers or {}).values())}, **{f"_t{k}": F.trim(F.coalesce(c, F.lit(""))) for k, c in enumerate((types or {}).values())}}
    shown = rows.withColumn("_seq", F.monotonically_increasing_id()).select("_seq", *[f.alias(f"k_{c}") for c, f in text.items()], *[F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(NOTHING)).alias(f"_p{k}") for k, c in enumerate(parents)], *[f.alias(c) for c, f in rest.items()])
    shown = written(shown, f"{path}/rows")
    label = F.when(F.col("k_id") != "", F.col("k_id")).otherwise(F.concat(F.lit("row "), F.col("_seq") + 1))
    bad = F.when(F.col("k_name") == "", "missing_field").when(~is_fhir_id(F.col("k_id")), "invalid_id")
    issues = shown.where(bad.isNotNull()).select(bad.alias("kind"), label.alias("location_id"), F.lit("row left out").alias("detail"))
    good = shown.where(bad.isNull())
    twice = good.groupBy("k_id").count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"the id {twice[0]['k_id']} occurs more than once")
    placed = bake.chain_lookup(good, admins, [f"_p{k}" for k in range(len(parents))]) if parents else good.withColumns({"parent": F.lit(None).cast("string"), "misses": F.lit(None).cast("int")})
    # a chain whose first name is unknown resolves nothing, not the root
    placed = placed.withColumn("parent", F.when(F.coalesce("misses", F.lit(-1)) != 0, F.col("parent")))
    lat, lon = F.col("k_lat").try_cast("double"), F.col("k_lon").try_cast("double")
    at = F.when(lat.between(-90, 90) & lon.between(-180, 180), F.struct(lon.alias("longitude"), lat.alias("latitude")))
    placed = written(placed.withColumn("position", at), f"{path}/placed")
    issues = issues.unionByName(placed.where("position is null").select(F.lit("missing_position").alias("kind"), F.col("k_id").alias("location_id"), F.concat_ws(", ", "k_lat", "k_lon").alias("detail")))
    issues = issues.unionByName(placed.where("misses is not null").select(F.lit("parent_unresolved").alias("kind"), F.col("k_id").alias("location_id"), F.concat(F.lit("column "), F.col("misses") + 1, F.lit(" names no unit")).alias("detail")))

    def listed(prefix: str, systems: list[str], make) -> Column:
        found = F.array(*[F.when(F.col(f"{prefix}{k}") != "", make(s, F.col(f"{prefix}{k}"))) for k, s in enumerate(systems)]) if systems else F.array()
        return F.array_compact(found)

    codes = listed("_t", list(types or {}), lambda s, v: F.struct(F.array(F.struct(F.lit(s).alias("system"), slugify(v).alias("code"), v.alias("display"))).alias("coding"))) if types else None
    first = F.struct(F.array(F.struct(F.lit(own.codes("location-type")).alias("system"), F.lit(kind).alias("code"), F.lit(None).cast("string").alias("display"))).alias("coding"))
    held = listed("_i", list(identifiers or {}), lambda s, v: F.struct(F.lit(s).alias("system"), v.alias("value"))) if identifiers else F.lit(None).cast("array<struct<system:string,value:string>>")
    held = F.when(F.size(held) > 0, held)
    extension = F.lit(None).cast("array<struct<url:string>>")
    if cells:
        from ..functions.cells import geohash, quadkey

        compute = {"quadkey": quadkey, "geohash": geohash}
        part = [F.struct(F.lit(own.extension("spatial-index")).alias("url"), F.array(F.struct(F.lit("system").alias("url"), F.lit(s).alias("valueCode"), F.lit(None).cast("int").alias("valueUnsignedInt"), F.lit(None).cast("string").alias("valueString")), F.struct(F.lit("level").alias("url"), F.lit(None).cast("string").alias("valueCode"), F.lit(n).alias("valueUnsignedInt"), F.lit(None).cast("string").alias("valueString")), F.struct(F.lit("cell").alias("url"), F.lit(None).cast("string").alias("valueCode"), F.lit(None).cast("int").alias("valueUnsignedInt"), compute[s](F.col("position.longitude"), F.col("position.latitude"), n).alias("valueString"))).alias("extension")) for s, n in cells]
        extension = F.when(F.col("position").isNotNull(), F.array(*part))
    place = F.to_json(F.struct(
        F.lit("Location").alias("resourceType"), F.col("k_id").alias("id"), F.col("k_name").alias("name"), F.lit("active").alias("status"), (F.concat(F.array(first), codes) if codes is not None else F.array(first)).alias("type"), _coded("http://terminology.hl7.org/CodeSystem/location-physical-type", "si").alias("physicalType"),
        held.alias("identifier"), F.when(F.col("parent").isNotNull(), F.struct(F.concat(F.lit("Location/"), "parent").alias("reference"))).alias("partOf"), "position", (F.struct(F.concat(F.lit("Organization/org-"), "k_id").alias("reference")) if paired else F.lit(None).cast("struct<reference:string>")).alias("managingOrganization"), extension.alias("extension"),
    ))
    provider = F.struct(F.array(F.struct(F.lit("http://terminology.hl7.org/CodeSystem/organization-type").alias("system"), F.lit("prov").alias("code"), F.lit("Healthcare Provider").alias("display"))).alias("coding"))
    organization = F.to_json(F.struct(F.lit("Organization").alias("resourceType"), F.concat(F.lit("org-"), "k_id").alias("id"), F.lit(True).alias("active"), F.col("k_name").alias("name"), (F.concat(F.array(provider), codes) if codes is not None else F.array(provider)).alias("type"), held.alias("identifier")))
    both = F.array(*([F.struct(F.lit(0).alias("place"), F.concat(F.lit("org-"), "k_id").alias("id"), organization.alias("json"))] if paired else []), F.struct(F.lit(1).alias("place"), F.col("k_id").alias("id"), place.alias("json")))
    return placed.select(F.col("_seq").alias("seq"), F.explode(both).alias("d")).select("seq", "d.*"), issues
