"""The dataflows, from files to files: transform, inspect, extract, export, diff, load, index, population.

Each returns its report: exact counts by kind of issue, and at most 1000 issues of a kind.
"""

from __future__ import annotations

import json
import os
from datetime import UTC, datetime
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cells import parse_cell_argument
from ..functions.documents import Profile, dumps, references
from ..operators import builders, bundles, edits, hierarchy, merge, places, raster
from ..operators.order import numbered, write_text as write_lines
from ..operators.reports import MOST_ISSUES, capped_issues, issue_counts
from ..sources import files, geoparquet, geotiff, rest, statistics
from ..workspace import folder, written


def _store(path: str, value: object) -> None:
    with open(f"{path}.part", "w") as f:
        json.dump(value, f, ensure_ascii=False, indent=2)
        f.flush()
        os.fsync(f.fileno())
    os.replace(f"{path}.part", path)


def report_of(issues: DataFrame, **more: object) -> dict:
    """The report of (kind, location_id, detail, and seq if there is an order of arrival): exact counts, the first issues of each kind.

    The plan behind the issues runs once, into a table; counts and issues come from that.
    """
    own = [F.col(c) if c in issues.columns else F.lit(None).cast("string").alias(c) for c in ("kind", "location_id", "detail", "seq")]
    found = written(issues.select(*own), f"{folder(issues.sparkSession)}/issues")
    counts = {r["kind"]: r["n"] for r in issue_counts(found).collect()}
    kept = capped_issues(found, MOST_ISSUES, ["seq", "location_id", "detail"]).orderBy("kind", "nth").select("kind", "location_id", "detail").collect()
    return {**more, "counts": counts, "issues": [r.asDict() for r in kept], "truncated": {k: n - MOST_ISSUES for k, n in counts.items() if n > MOST_ISSUES}}


def transform(spark: SparkSession, snapshot: str, out: str, country: str | None = None, row_group_size: int = geoparquet.ROWS_IN_GROUP, partition_by: str = "country,geom_type,type", keep_without_geometry: bool = False, profile: Profile | None = None) -> dict:
    keys = tuple(partition_by.split(","))
    if bad := set(keys) - {"country", "geom_type", "tier", "type"}:
        raise ValueError(f"not a partition key: {', '.join(sorted(bad))}")
    report_path = f"{out.rstrip('/')}/_report.json"
    if os.path.exists(report_path):
        os.remove(report_path)
    path = folder(spark)
    flat = written(places.flatten(files.read_lines(spark, f"{snapshot}/locations.ndjson"), profile), f"{path}/flat")
    rows, issues = places.located(flat, country, keep_without_geometry, f"{path}/rows")
    issues = issues.unionByName(places.outside_parent(rows), allowMissingColumns=True)
    at = f"{snapshot}/organizations.ndjson"
    empty = {"nhfr_code": "string", "nhfr_uid": "string", "organization_identifier": "array<struct<system:string,value:string>>", "facility_level_text": "string", "ownership_text": "string", "organization_json": "string"}
    if os.path.exists(at):
        orgs = places.flatten_organizations(files.read_lines(spark, at), profile)
        rows, more = places.with_organizations(rows, orgs)
        rows, issues = written(rows, f"{path}/paired"), issues.unionByName(more, allowMissingColumns=True)
    else:
        rows = rows.withColumns({c: F.lit(None).cast(t) for c, t in empty.items()})
    manifest = geoparquet.write(rows.drop("chain", "seq", "cells", "boundary_url", "first_pcode"), out, keys, row_group_size)
    report = report_of(issues, read=flat.count(), written=sum(m["rows"] for m in manifest[:-1]), partitions=len({m["folder"] for m in manifest[:-1]}))
    for i in manifest[-1]["issues"]:
        report["counts"][i["kind"]] = report["counts"].get(i["kind"], 0) + 1
        report["issues"].append(i)
    _store(report_path, report)
    return report


def inspect(spark: SparkSession, out: str) -> dict:
    rows = geoparquet.inspect(spark, out)
    total = rows.agg(F.count("*").alias("files"), F.sum("rows").alias("rows"), F.sum("row_groups").alias("row_groups"), F.sum("bytes").alias("bytes"), F.min("least").alias("least"), F.max("most").alias("most")).first().asDict()
    total["mean"] = int(total["rows"] / total["row_groups"] + 0.5) if total["row_groups"] else 0
    return total


def extract(spark: SparkSession, server: str, snapshot: str, full: bool = False, since: str | None = None, token: str | None = None, concurrency: int = 8, retries: int = 3, max_failures: int = 50, cache_dir: str | None = None, refresh: bool = False, profile: Profile | None = None) -> dict:
    """Pulls what changed since the last run's high-water mark, fetches boundaries, and merges into the snapshot."""
    os.makedirs(snapshot, exist_ok=True)
    state_path, client, path = f"{snapshot}/state.json", rest.Client(server, token=token, retries=retries), folder(spark)
    state = json.load(open(state_path)) if os.path.exists(state_path) and not full else {}
    if state and state["server"] != server:
        raise ValueError(f"the snapshot was pulled from {state['server']}")
    spark.dataSource.register(rest.Search)
    report, marks = {}, {}
    for kind, name in (("Location", "locations"), ("Organization", "organizations")):
        mark = since or state.get(f"{name}_watermark")
        options = {"server": server, "types": kind, "retries": str(retries)} | ({"since": mark} if mark else {}) | ({"token": token} if token else {})
        pulled = written(spark.read.format("fhir_search").options(**options).load(), f"{path}/{name}")
        new = pulled.where("text is not null").select(F.get_json_object("text", "$.id").alias("id"), F.get_json_object("text", "$.meta.lastUpdated").alias("updated"), "seq", "text")
        if kind == "Location":
            new = _with_boundaries(spark, new, client, rest.Cache(cache_dir or f"{snapshot}/cache"), refresh, concurrency, max_failures, profile or Profile(), report)
        target = f"{snapshot}/{name}.ndjson"
        incoming = new.select("id", F.struct(F.lit("").alias("file"), F.lit(0).cast("long").alias("start"), F.col("seq").alias("row")).alias("seq"), "text")
        old = incoming.limit(0) if full or not os.path.exists(target) else files.read_lines(spark, target).select(F.get_json_object("text", "$.id").alias("id"), "seq", "text")
        merged = written(merge.upsert(old, incoming, full), f"{path}/{name}-merged")
        top = merge.watermark(new, "updated").first()["watermark"]
        marks |= {f"{name}_watermark": top or mark, f"{name}_count": write_lines(merged, target, ["source", "seq"])}
        report[name] = {"pulled": new.count(), "total": marks[f"{name}_count"], "skipped": pulled.where("issue is not null").count()}
        held = rest.count(client, kind)
        if held is not None and held != marks[f"{name}_count"]:
            report[name]["count_mismatch"] = held
    _store(state_path, {"server": server, **marks, "completed_at": datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")})
    return report


def _with_boundaries(spark, new: DataFrame, client, cache, refresh: bool, workers: int, breaker: int, profile: Profile, report: dict) -> DataFrame:
    """Puts fetched boundaries in place of their URLs. URLs are fetched in order through one pool, as the breaker needs their order."""
    import base64

    from pyspark.sql.functions import pandas_udf

    names = list(profile.boundaries)

    @pandas_udf("string")
    def url_of(texts):
        def one(text: str) -> str | None:
            found = [e.get("valueAttachment") or {} for e in json.loads(text).get("extension") or [] if isinstance(e, dict) and e.get("url") in names]
            return next((a["url"] for a in found if not a.get("data") and a.get("url")), None)

        return texts.map(one)

    noted = new.withColumn("boundary", url_of("text"))
    urls = [r["boundary"] for r in noted.where("boundary is not null").select("boundary").distinct().orderBy("boundary").toLocalIterator()]
    fetched = []
    for url, raw, issue in rest.fetch_all(urls, client, cache, refresh, workers, breaker):
        if issue:
            report.setdefault("boundary_issues", []).append([url, issue])
        if raw is not None:
            fetched.append((url, base64.b64encode(places.boundary_from_payload(raw)).decode()))
    if not fetched:
        return noted.drop("boundary")
    table = spark.createDataFrame(fetched, "_url string, data string")

    @pandas_udf("string")
    def inline(texts, data):
        def one(text: str, body: str | None) -> str:
            if body is None:
                return text
            doc = json.loads(text)
            for e in doc.get("extension") or []:
                if isinstance(e, dict) and e.get("url") in names and isinstance(e.get("valueAttachment"), dict) and not e["valueAttachment"].get("data"):
                    e["valueAttachment"] = {k: v for k, v in e["valueAttachment"].items() if k != "url"} | {"data": body}
                    break
            return dumps(doc)

        import pandas as pd

        return pd.Series([one(t, b) for t, b in zip(texts, data, strict=True)])

    return noted.join(table, F.col("boundary") == F.col("_url"), "left").withColumn("text", inline("text", "data")).drop("boundary", "_url", "data")


def export(spark: SparkSession, server: str, types: list[str], out: str, token: str | None = None) -> dict:
    """Every resource of each type as one NDJSON file; where a last page is full, the server's own count tells whether that was all."""
    if bad := [t for t in types if not t.isalpha() or not t[0].isupper()]:
        raise ValueError(f"not a resource type: {', '.join(bad)}")
    spark.dataSource.register(rest.Search)
    types = list(dict.fromkeys(types))
    rows = written(spark.read.format("fhir_search").options(server=server, types=",".join(types), **({"token": token} if token else {})).load(), f"{folder(spark)}/export")
    n = write_lines(rows.where("text is not null"), out, ["type", "seq"])
    held = {r["type"]: (r["n"], r["found"]) for r in rows.groupBy("type").agg(F.count("*").alias("n"), F.count("text").alias("found")).collect()}
    client, short = rest.Client(server, token=token), {}
    for kind, (entries, _) in sorted(held.items()):
        if entries % rest.PAGE == 0 and (said := rest.count(client, kind)) not in (None, entries):
            short[kind] = said
    return {"written": n, **{kind: found for kind, (_, found) in held.items()}, **({"count_mismatch": short} if short else {})}


def diff(spark: SparkSession, snapshot: str, given: str, out: str, profile: Profile | None = None) -> dict:
    """Edited features or rows against the snapshot, as the documents that change."""
    kind = files.format_of(given)
    rows = edits.rows_of_table(geoparquet.read(spark, given)) if kind == "geoparquet" else edits.rows_of_features(files.read_features(spark, given))

    def raw(name: str) -> DataFrame | None:
        at = f"{snapshot}/{name}.ndjson"
        return files.read_lines(spark, at).select(F.get_json_object("text", "$.id").alias("id"), "text", "seq") if os.path.exists(at) else None

    changes = written(edits.changed_documents(rows, raw("locations"), raw("organizations"), profile), f"{folder(spark)}/changes")
    n = write_lines(edits.documents(changes), out, ["seq", "place"])
    actions = {r["action"]: r["count"] for r in changes.groupBy("action").count().collect()}
    return report_of(changes.select(F.explode("issues").alias("i")).select("i.*"), written=n, actions=actions)


def load(spark: SparkSession, given: str, server: str | None = None, dry_run: bool = False, batch_size: int = 100, concurrency: int = 1, token: str | None = None, retries: int = 3) -> dict:
    """Plans bundles with the cluster and posts them in an order that respects references; a dry run returns the plan.

    Its bundles are posted from here, one in memory for each worker.
    """
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("array<string>")
    def refs(texts):
        return texts.map(lambda t: references(json.loads(t)))

    lines = files.expand_bundles(files.read_lines(spark, given))
    docs = lines.select(F.get_json_object("text", "$.resourceType").alias("type"), F.get_json_object("text", "$.id").alias("id"), F.substring_index(F.get_json_object("text", "$.partOf.reference"), "/", -1).alias("part_of"), "seq", "text")
    path = folder(spark)
    docs = numbered(written(docs, f"{path}/docs"), ["seq"], "nth").drop("seq").withColumnRenamed("nth", "seq")
    twice = docs.groupBy("type", "id").count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{twice[0]['type']}/{twice[0]['id']} occurs twice")
    planned = bundles.into_bundles(bundles.load_order(docs.select("type", "id", "part_of", "seq")), batch_size)
    if planned.where("dropped is not null").limit(1).count():
        raise ValueError("the resources' parents form a cycle")
    # a bundle's documents lie together: the plan is read once, from its first bundle to its last
    ordered = written(planned.join(docs.select("seq", "text"), "seq").orderBy("place"), f"{path}/plan")
    found = ordered.select("type", "id", F.explode(refs("text")).alias("r")).select("type", "id", F.substring_index("r", "/", 1).alias("ref_type"), F.substring_index("r", "/", -1).alias("ref_id"))
    needs: dict[int, set[int]] = {}
    for r in bundles.dependencies(ordered, found).collect():
        needs.setdefault(r["bundle"], set()).add(r["needs"])
    if dry_run:
        plan = ordered.select("bundle", F.concat_ws("", F.when(F.get_json_object("text", "$.meta.versionId").isNull(), "create ").otherwise("update "), "type", F.lit("/"), "id").alias("what"), "place").orderBy("place")
        return {"plan": [(r["bundle"], r["what"]) for r in plan.toLocalIterator()], "needs": {k: sorted(v) for k, v in needs.items()}}
    client = rest.Client(server, token=token, retries=retries)
    created = {r["type"] for r in ordered.where("get_json_object(text, '$.meta.versionId') is null").select("type").distinct().collect()}
    warnings = rest.preflight(client.get("metadata"), created)

    def post(resources: list[dict]) -> None:
        try:
            client.call("", rest.transaction(resources))
        except rest.Refused as e:
            if e.status in (409, 412):
                raise ValueError("; ".join(rest.conflicts(client, resources)) or str(e)) from e
            raise

    rows = ordered.select("bundle", "text", "place").orderBy("place").toLocalIterator(prefetchPartitions=True)
    whole = ((n, [json.loads(r["text"]) for r in group]) for n, group in groupby(rows, key=lambda r: r["bundle"]))
    return {"bundles": len(rest.post_stream(whole, needs, post, concurrency)), "warnings": warnings}


def index(spark: SparkSession, snapshot: str, cells: list[str], out: str, refresh: bool = False, profile: Profile | None = None) -> dict:
    schemes = [parse_cell_argument(c) for c in cells]
    done = written(edits.backfill_cells(files.read_lines(spark, f"{snapshot}/locations.ndjson"), schemes, refresh, profile), f"{folder(spark)}/cells")
    n = write_lines(done.where("text is not null"), out, ["seq"])
    return report_of(done.select(F.col("status").alias("kind"), F.col("id").alias("location_id"), F.lit("").alias("detail")), written=n)


def population(spark: SparkSession, snapshot: str, raster_path: str, level: int, year: int, out: str, source: str = "worldpop", profile: Profile | None = None) -> dict:
    """Sums a raster (a file, or a URL that is kept in the snapshot's cache) over the units of a level, rolls them up, and writes a group for each unit."""
    path = folder(spark)
    if "://" in raster_path:
        raster_path = statistics.raster_file(raster_path, rest.Cache(f"{snapshot}/cache"), rest.Client(raster_path, timeout=3600))
    flat = written(places.flatten(files.read_lines(spark, f"{snapshot}/locations.ndjson"), profile), f"{path}/flat")
    rows, issues = places.located(flat, None, True, f"{path}/rows")
    grid, leaves = geotiff.read_grid(raster_path), rows.where(F.col("admin_level") == level)
    tiles = geotiff.tiles(spark, raster_path)
    sums = written(raster.polygon_sums(tiles, leaves.where("geom_type = 'polygon'").select("id", "geometry", "bbox"), grid), f"{path}/sums")
    rolled = raster.roll_up(leaves.select("id", "geom_type").join(sums, "id", "left").withColumns({"total": F.when(F.col("geom_type") == "polygon", F.coalesce("total", F.lit(0.0))), "pixels": F.coalesce("pixels", F.lit(0))}).drop("geom_type"), hierarchy.admin_ancestors(leaves).select("id", "ancestor"))
    docs, more = builders.population_groups(rolled, source, year, profile)
    n = write_lines(docs, out, ["id"], "json")
    total = raster.grand_total(tiles, grid.nodata)
    return report_of(more, written=n, raster_total=total.first()["total"] or 0.0, assigned_percent=raster.assigned_share(sums, total).first()["assigned"])
