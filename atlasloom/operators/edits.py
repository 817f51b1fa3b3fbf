"""From edited table rows to the minimal set of changed documents."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions import patches
from ..functions.documents import Profile, dumps, parse_location
from .hierarchy import first_of_each

_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the public namespace for URLs


def rows_of_features(features: DataFrame) -> DataFrame:
    """(seq, id, cells as JSON, geometry as WKB, issues) of GeoJSON features; an absent column stays absent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for props, shape, feature_id in zip(*(batch.column(c).to_pylist() for c in ("properties", "geometry", "feature_id")), strict=True):
                raw, issues, wkb = json.loads(props), [], None
                cells, bad = patches.cells_of(raw)
                key = raw.get("id") or feature_id
                issues += [("input_column_type", c) for c in bad]
                if shape:
                    try:
                        found, extra = geo.from_geojson(json.loads(shape))
                        wkb = geo.to_wkb(found) if found[0] in ("point", "polygon", "multipolygon") else None
                        issues += [("boundary_z_dropped", "3D coordinates flattened to 2D")] * extra + [("geometry_unparseable", found[0])] * (wkb is None)
                    except ValueError as e:
                        issues.append(("geometry_unparseable", str(e)))
                out.append({"id": None if key in (None, "") else str(key), "cells": dumps(cells), "wkb": wkb, "issues": [{"kind": k, "location_id": str(key or ""), "detail": d} for k, d in issues]})
            body = pa.RecordBatch.from_pylist(out, pa.schema([("id", pa.string()), ("cells", pa.string()), ("wkb", pa.binary()), ("issues", pa.list_(pa.struct([(c, pa.string()) for c in ("kind", "location_id", "detail")])))]))
            yield pa.RecordBatch.from_arrays([batch.column("seq"), *body.columns], names=["seq", "id", "cells", "wkb", "issues"])

    kind = features.schema["seq"].dataType.simpleString()
    return features.mapInArrow(run, f"seq {kind}, id string, cells string, wkb binary, issues array<struct<kind:string,location_id:string,detail:string>>")


def rows_of_table(rows: DataFrame) -> DataFrame:
    """The same shape from a table read from a dataset: every writable column is given, derived ones are ignored."""
    own = [c for c in rows.columns if c in patches.WRITABLE]
    shape = F.col("geometry") if "geometry" in rows.columns else F.lit(None).cast("binary")
    none = F.array().cast("array<struct<kind:string,location_id:string,detail:string>>")
    cells = F.to_json(F.struct(*own), {"ignoreNullFields": "false"})
    return rows.select(F.monotonically_increasing_id().alias("seq"), F.nullif(F.col("id").cast("string"), F.lit("")).alias("id"), cells.alias("cells"), shape.alias("wkb"), none.alias("issues"))


def changed_documents(edits: DataFrame, snapshot: DataFrame, organizations: DataFrame | None = None, profile: Profile | None = None) -> DataFrame:
    """(seq, kind, id, json, action, issues): one row per edited row, with the changed place (and organization) as JSON, or null if unchanged.

    edits as from rows_of_*; snapshot and organizations: (seq, id, text), the raw lines, of which the first of an id counts.
    An edit meets its document by a join on id and its organization by one on the reference it has after the edit. Repeated ids after the
    first are skipped and reported; rows without an id get one made from their place in the input.
    """
    own = profile or Profile()
    named = edits.withColumn("given", F.col("id").isNotNull()).withColumn("id", F.coalesce("id", F.concat(F.lit("new:"), F.to_json(F.struct("seq")))))
    first = first_of_each(named.select("id", "seq", "cells", "wkb", "issues", "given"))
    base = first_of_each(snapshot).select(F.col("id").alias("_i"), F.col("text").alias("base"))
    joined = first.join(base, F.col("id") == F.col("_i"), "left").drop("_i")
    if organizations is None:
        joined = joined.withColumns({"organization": F.lit(None).cast("string"), "with_organizations": F.lit(False)})
    else:
        after = F.expr("if(instr(cells, '\"managing_organization\"') > 0, get_json_object(cells, '$.managing_organization'), substring_index(get_json_object(base, '$.managingOrganization.reference'), '/', -1))")
        orgs = first_of_each(organizations).select(F.col("id").alias("_o"), F.col("text").alias("organization"))
        joined = joined.withColumn("_ref", after).join(orgs, F.col("_ref") == F.col("_o"), "left").drop("_o", "_ref").withColumn("with_organizations", F.lit(True))

    def edit(r: dict) -> tuple[str | None, str | None, str, list[dict]]:
        key = r["id"] if r["given"] else str(uuid.uuid5(_NAMESPACE, r["id"]))
        issues = list(r["issues"] or [])

        def say(kind: str, detail: str) -> None:
            issues.append({"kind": kind, "location_id": key, "detail": detail})

        (cells, bad), new = patches.cells_of(json.loads(r["cells"])), r["base"] is None
        for column in bad:
            say("input_column_type", column)
        if new:
            say("new_location" if r["given"] else "new_location_generated_id", "not in the snapshot")
        before = {"resourceType": "Location", "id": key} if new else json.loads(r["base"])
        shape = geo.from_wkb(r["wkb"]) if r["wkb"] else None
        place = patches.rebuild(before, cells, shape, own, say)
        organization, target = None, patches.organization_of(place)
        if r["with_organizations"]:
            old = None if new else parse_location(r["base"], own)[0]
            if r["organization"]:
                held = json.loads(r["organization"])
                after = patches.rebuild_organization(held, cells, old, own)
                organization = dumps(after) if patches.changed(held, after) else None
            elif target:
                say("organization_missing", target)
            elif new and cells.get("type") == "facility":
                made = patches.rebuild_organization({"resourceType": "Organization", "id": f"org-{key}"}, cells, None, own)
                organization, place["managingOrganization"] = dumps(made), {"reference": f"Organization/org-{key}"}
        written = dumps(place) if new or patches.changed(before, place) else None
        return written, organization, "created" if new else "changed" if written else "unchanged", issues

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        issue = pa.list_(pa.struct([(c, pa.string()) for c in ("kind", "location_id", "detail")]))
        for batch in batches:
            out = [edit(r) for r in batch.drop_columns(["seq"]).to_pylist()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 4, (pa.string(), pa.string(), pa.string(), issue), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("seq"), batch.column("id"), *columns], names=["seq", "id", "location", "organization", "action", "issues"])

    kind = edits.schema["seq"].dataType.simpleString()
    done = joined.select("seq", "id", "cells", "wkb", "issues", "given", "base", "organization", "with_organizations").mapInArrow(run, f"seq {kind}, id string, location string, organization string, action string, issues array<struct<kind:string,location_id:string,detail:string>>")
    taken = first.select(F.col("id").alias("_i"), F.col("seq").alias("_s"))
    again = named.join(taken, (F.col("id") == F.col("_i")) & (F.col("seq") > F.col("_s"))).select("seq", "id", F.lit(None).cast("string").alias("location"), F.lit(None).cast("string").alias("organization"), F.lit("skipped").alias("action"), F.array(F.struct(F.lit("duplicate_id").alias("kind"), F.col("id").alias("location_id"), F.lit("repeated in the input").alias("detail"))).alias("issues"))
    return done.unionByName(again)


def documents(changes: DataFrame) -> DataFrame:
    """(seq, place, text): what is to be loaded, an organization before its place."""
    both = F.array(F.struct(F.lit(0).alias("place"), F.col("organization").alias("text")), F.struct(F.lit(1).alias("place"), F.col("location").alias("text")))
    return changes.select("seq", F.explode(both).alias("d")).select("seq", "d.*").where("text is not null")


def backfill_cells(lines: DataFrame, schemes: list[tuple[str, int]], refresh: bool = False, profile: Profile | None = None) -> DataFrame:
    """(seq, id, text, status): documents that gain or change a cell; status no_position, already_indexed or indexed."""
    own = profile or Profile()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, status = [], [], []
            for text in batch.column("text").to_pylist():
                try:
                    obj = json.loads(text)
                except ValueError:
                    obj = {}
                place = patches.position_of(obj) if isinstance(obj, dict) else None
                ids.append(obj.get("id") if isinstance(obj, dict) else None)
                if place is None:
                    texts.append(None)
                    status.append("no_position")
                    continue
                held = {(c["scheme"], c["level"]) for e in obj.get("extension") or [] if isinstance(e, dict) and e.get("url") == own.extension("spatial-index") and (c := patches.cell_of(e))}
                edited = [patches.upsert_cell(obj, own, s, n, patches.COMPUTED[s](*place, n)) for s, n in schemes if refresh or (s, n) not in held]
                texts.append(dumps(obj) if any(edited) else None)
                status.append("indexed" if any(edited) else "already_indexed")
            yield pa.RecordBatch.from_arrays([batch.column("seq"), pa.array(ids, pa.string()), pa.array(texts, pa.string()), pa.array(status, pa.string())], names=["seq", "id", "text", "status"])

    return lines.select("seq", "text").mapInArrow(run, f"seq {lines.schema['seq'].dataType.simpleString()}, id string, text string, status string")
