"""Queries over boundaries, rasters and datasets made from the driver's tables, each through the operators that the dataflows use."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cells
from ..functions import geometry as geo
from ..functions.documents import Profile
from ..operators import hierarchy, mapping, merge, places, raster
from ..sources import geoparquet, geotiff
from ..workspace import folder, written
from . import views
from .catalog import _once, query
from .catalog_documents import _bounded, _box, _member, _quoted, _text

P = Profile()


def _n() -> Column:
    return F.col("n_nationkey")


def _s() -> Column:
    return F.col("s_suppkey")


#: Triangles of the nations: corners (x, y), (x + 6, y), (x + 3, y + 5).
_TRIANGLES = "t AS (SELECT n_nationkey AS k, n_regionkey, n_nationkey * 7.0 - 90 AS x, (n_nationkey % 5) * 8.0 - 20 AS y FROM nation)"


def _triangle(x, y):
    at = [(x, y), (x + 6, y), (x + 3, y + 5), (x, y)]
    return _text('{"type":"Polygon","coordinates":[[', *[p for i, (a, b) in enumerate(at) for p in (("," if i else "") + "[", a.cast("string"), ",", b.cast("string"), "]")], "]]}")


def _corner() -> tuple:
    return (_n() * 7.0 - 90).cast("double"), ((_n() % 5) * 8.0 - 20).cast("double")


def _registry(spark, sf_dir) -> DataFrame:
    """Lines of regions without a boundary, nations with a triangle, and suppliers as points in and around their nation's."""
    n, s = views.table(spark, sf_dir, "nation"), views.table(spark, sf_dir, "supplier")
    kind = ',"type":[{"coding":[{"system":"kinds","code":"'
    code = _text(',"identifier":[{"system":"', P.identifier("pcode"), '","value":"')
    regions = views.table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("seq"), _text('{"resourceType":"Location","id":"r', F.col("r_regionkey"), '","name":"', F.col("r_name"), '"', kind, 'admin-unit"}]}]', code, "R", F.col("r_regionkey"), '"}]}').alias("text"))
    nations = n.select((_n() + 100).cast("long"), _text('{"resourceType":"Location","id":"n', _n(), '","name":"', F.col("n_name"), '"', kind, 'admin-unit"}]}],', _bounded(_triangle(*_corner())), _member("partOf", F.when(_n() % 9 != 8, _text('{"reference":"Location/r', F.col("n_regionkey"), '"}'))), "}"))
    x, y = _corner()
    at = s.join(n.select(_n(), x.alias("x"), y.alias("y")), F.col("s_nationkey") == _n())
    lon, lat = F.col("x") + (_s() * 13 % 41) / 4.0 - 1, F.col("y") + (_s() * 29 % 37) / 4.0 - 1
    sites = at.select((_s() + 1000).cast("long"), _text('{"resourceType":"Location","id":"s', _s(), '","name":', _quoted(F.col("s_name")), kind, 'facility"}]}],"partOf":{"reference":"Location/n', _n(), '"},"position":{"longitude":', lon.cast("string"), ',"latitude":', lat.cast("string"), "}}"))
    return regions.unionAll(nations).unionAll(sites)


def _flat(spark, sf_dir) -> DataFrame:
    return _once(spark, sf_dir, "flat", lambda: places.flatten(_registry(spark, sf_dir)))


def _rows(spark, sf_dir) -> DataFrame:
    return _once(spark, sf_dir, "rows", lambda: places.located(_flat(spark, sf_dir))[0])


_POINTS = f"""{_TRIANGLES}, p AS (SELECT s_suppkey AS s, k, x, y, n_regionkey, (s_suppkey * 13 % 41) / 4.0 - 1 AS dx, (s_suppkey * 29 % 37) / 4.0 - 1 AS dy FROM supplier JOIN t ON s_nationkey = k)"""


@query(f"WITH {_POINTS} SELECT 's' || s AS location_id, 'outside n' || k AS detail FROM p WHERE NOT (dy >= 0 AND 3 * dy <= 5 * dx AND 3 * dy <= 5 * (6 - dx))")
def q_point_outside_parent(spark, sf_dir):
    return places.outside_parent(_rows(spark, sf_dir)).where("location_id like 's%'").select("location_id", "detail")


@query(f"WITH {_TRIANGLES} SELECT 'n' || k AS id, x AS xmin, y AS ymin, x + 6 AS xmax, y + 5 AS ymax, true AS inside FROM t")
def q_polygon_bounds(spark, sf_dir):
    """Bounding boxes, and whether the point that stands for each polygon lies inside it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inside = [bool(geo.intersects(geo.from_wkb(w), x, y)[0]) for w, x, y in zip(*(batch.column(c).to_pylist() for c in ("geometry", "lon", "lat")), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(inside, pa.bool_())], names=["id", "inside"])

    flat = _flat(spark, sf_dir).where("geom_type = 'polygon'")
    return flat.select("id", "bbox.*").join(flat.select("id", "geometry", "lon", "lat").mapInArrow(run, "id string, inside boolean"), "id")


@query(f"""WITH {_POINTS} SELECT 's' || s AS id, CASE WHEN k % 9 = 8 THEN 'unknown' ELSE 'R' || n_regionkey END AS country, 'site' AS tier, CASE WHEN k % 9 = 8 THEN 1 ELSE 2 END::INTEGER AS depth, x + dx AS lon, y + dy AS lat FROM p""")
def q_located_sites(spark, sf_dir):
    return _rows(spark, sf_dir).where("type = 'facility'").select("id", "country", "tier", "depth", "lon", "lat")


@query("""SELECT kind, count(*)::BIGINT AS n FROM (SELECT 'no_geometry' AS kind FROM region UNION ALL SELECT 'no_country' FROM nation WHERE n_nationkey % 9 = 8 UNION ALL SELECT 'no_country' FROM supplier WHERE s_nationkey % 9 = 8) GROUP BY kind""")
def q_registry_issues(spark, sf_dir):
    _, issues = places.located(_flat(spark, sf_dir), path=f"{folder(spark)}/located")
    return issues.groupBy("kind").agg(F.count("*").alias("n"))


@query(f"WITH {_POINTS} SELECT CASE WHEN k % 9 = 8 THEN 'unknown' ELSE 'R' || n_regionkey END AS country, 'point' AS geom_type, count(*)::BIGINT AS n, min(x + dx) AS xmin, max(y + dy) AS ymax FROM p GROUP BY ALL")
def q_dataset_read_back(spark, sf_dir):
    """The registry as a partitioned dataset, read again."""
    out = _dataset(spark, sf_dir)
    back = geoparquet.read(spark, out).where("geom_type = 'point'")
    return back.groupBy("country", "geom_type").agg(F.count("*").alias("n"), F.min("bbox.xmin").alias("xmin"), F.max("bbox.ymax").alias("ymax"))


_outs: dict[tuple[str, str], str] = {}


def _dataset(spark, sf_dir) -> str:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _outs:
        _outs[key] = folder(spark).removeprefix("file:") + "/dataset"
        while _outs[key].startswith("//"):
            _outs[key] = _outs[key][1:]
        rows = _rows(spark, sf_dir)
        geoparquet.write(rows.drop("chain", "seq", "cells", "boundary_url", "first_pcode"), _outs[key], rows_in_group=50)
    return _outs[key]


@query(f"""WITH {_POINTS}, a AS (SELECT count(*) AS n FROM p GROUP BY CASE WHEN k % 9 = 8 THEN -1 ELSE n_regionkey END UNION ALL SELECT count(*) FROM t GROUP BY CASE WHEN k % 9 = 8 THEN -1 ELSE n_regionkey END)
SELECT sum(n)::BIGINT AS rows, least(50, max(n))::BIGINT AS most, true AS whole FROM a""")
def q_dataset_inspection(spark, sf_dir):
    found = geoparquet.inspect(spark, _dataset(spark, sf_dir))
    return found.agg(F.sum("rows").alias("rows"), F.max("most").alias("most"), F.bool_and(F.col("mean") <= F.col("most")).alias("whole"))


@query(f"""WITH {_POINTS}, a AS (SELECT CASE WHEN k % 9 = 8 THEN 'unknown' ELSE 'R' || n_regionkey END || '/point/facility' AS location_id, count(*) AS n FROM p GROUP BY ALL
    UNION ALL SELECT CASE WHEN k % 9 = 8 THEN 'unknown' ELSE 'R' || n_regionkey END || '/polygon/admin-unit', count(*) FROM t GROUP BY ALL) SELECT location_id, n::VARCHAR AS detail FROM a WHERE n < 100""")
def q_dataset_small_partitions(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    out = folder(spark).removeprefix("file:").replace("//", "/") + "/small"
    found = geoparquet.write(rows.drop("chain", "seq", "cells", "boundary_url", "first_pcode"), out)[-1]["issues"]
    return spark.createDataFrame([(i["location_id"], i["detail"]) for i in found if i["kind"] == "small_partition"], "location_id string, detail string")


_CASES = "SELECT p_partkey AS k, p_partkey % 8 AS m FROM part"


@query(f"""WITH c AS ({_CASES}) SELECT 'p' || k AS id, CASE WHEN m IN (0, 1, 5) THEN 'polygon' WHEN m IN (2, 6) THEN 'point' END AS geom_type,
    CASE m WHEN 1 THEN 'boundary_multi_feature' WHEN 3 THEN 'geometry_unexpected_type' WHEN 4 THEN 'boundary_unparseable,no_geometry' WHEN 5 THEN 'geometry_invalid' WHEN 6 THEN 'boundary_z_dropped' WHEN 7 THEN 'boundary_bad_content_type,no_geometry' ELSE '' END AS issues FROM c""")
def q_boundary_kinds(spark, sf_dir):
    """Geometries, Features and collections; other types give no row, what cannot be read gives no geometry."""
    m = F.col("p_partkey") % 8
    one, two = _box(F.lit(0.0), F.lit(0.0), F.lit(1.0)), _box(F.lit(5.0), F.lit(5.0), F.lit(1.0))
    shape = (
        F.when(m == 0, _text('{"type":"Feature","geometry":', one, "}")).when(m == 1, _text('{"type":"FeatureCollection","features":[{"geometry":', one, '},{"geometry":', two, "}]}")).when(m == 2, '{"type":"Point","coordinates":[1,2]}')
        .when(m == 3, '{"type":"LineString","coordinates":[[1,2],[3,4]]}').when(m == 4, '{"type":"Polygon","coordinates":[[[1]]]}').when(m == 5, '{"type":"Polygon","coordinates":[[[0,0],[2,2],[2,0],[0,2],[0,0]]]}').when(m == 6, '{"type":"Point","coordinates":[1,2,3]}').otherwise(one)
    )
    body = F.when(m == 7, F.replace(_bounded(shape), F.lit("geo+json"), F.lit("json"))).otherwise(_bounded(shape))
    lines = views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("seq"), _text('{"id":"p', F.col("p_partkey"), '",', body, "}").alias("text"))
    return places.flatten(lines).select("id", "geom_type", F.array_join(F.transform("issues", lambda i: i["kind"]), ",").alias("issues"))


_GRID = geotiff.Grid("", 360, 96, -92.0, 24.0, 0.5, 0.5, -4.0, (32, 32), [], [], 1, "<")
_VALUES = """v AS (SELECT r, c, -92.0 + (c + 0.5) * 0.5 AS lon, 24.0 - (r + 0.5) * 0.5 AS lat, ((r * 37 + c * 11) % 101 - 4) AS v FROM range(96) a(r), range(360) b(c))"""


def _tiles(spark) -> DataFrame:
    import numpy as np

    grid = _GRID

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for n in batch.column(0).to_pylist():
                ty, tx = divmod(n, grid.across)
                r, c = ty * 32 + np.arange(min(32, grid.height - ty * 32)), tx * 32 + np.arange(min(32, grid.width - tx * 32))
                data = ((r[:, None] * 37 + c * 11) % 101 - 4).astype("<f4")
                out.append({"tx": tx, "ty": ty, "row0": ty * 32, "col0": tx * 32, "width": len(c), "height": len(r), "data": data.tobytes()})
            yield pa.RecordBatch.from_pylist(out, pa.schema([(c, pa.int32()) for c in ("tx", "ty", "row0", "col0", "width", "height")] + [("data", pa.binary())]))

    return spark.range(grid.across * 3).mapInArrow(run, "tx int, ty int, row0 int, col0 int, width int, height int, data binary")


_SPANS = f"""{_TRIANGLES}, {_VALUES}, l AS (SELECT DISTINCT r, lat FROM v),
x AS (SELECT k, n_regionkey, r, x + (lat - y) / (y + 5 - y) * (x + 3 - x) AS a, x + 6 + (lat - y) / (y + 5 - y) * (x + 3 - (x + 6)) AS b FROM t JOIN l ON (y > lat) <> (y + 5 > lat)),
s AS (SELECT k, n_regionkey, r, ceil((a + 92.0) / 0.5 - 0.5)::BIGINT AS c0, ceil((b + 92.0) / 0.5 - 0.5)::BIGINT - 1 AS c1 FROM x),
z AS (SELECT k, n_regionkey, sum(greatest(v.v, 0))::DOUBLE AS total, count(*)::BIGINT AS pixels FROM s JOIN v ON v.r = s.r AND c BETWEEN c0 AND c1 AND v.v <> -4 GROUP BY ALL)"""


def _sums(spark, sf_dir) -> DataFrame:
    polygons = _flat(spark, sf_dir).where("geom_type = 'polygon'").select("id", "geometry", "bbox")
    return raster.polygon_sums(_tiles(spark), polygons, _GRID)


@query(f"WITH {_SPANS} SELECT 'n' || k AS id, total, pixels FROM z")
def q_polygon_sums(spark, sf_dir):
    return _sums(spark, sf_dir)


@query(f"WITH {_VALUES} SELECT sum(greatest(v, 0))::DOUBLE AS total, count(*)::BIGINT AS pixels FROM v WHERE v <> -4")
def q_raster_total(spark, sf_dir):
    return raster.grand_total(_tiles(spark), _GRID.nodata)


@query(f"WITH {_SPANS} SELECT round(100.0 * (SELECT sum(total) FROM z) / (SELECT sum(greatest(v, 0)) FROM v WHERE v <> -4), 2) AS assigned")
def q_assigned_share(spark, sf_dir):
    return raster.assigned_share(_sums(spark, sf_dir), raster.grand_total(_tiles(spark), _GRID.nodata))


@query(f"""WITH {_SPANS} SELECT 'n' || k AS id, round(total)::BIGINT AS quantity, false AS incomplete FROM z WHERE k % 9 <> 8 UNION ALL SELECT 'r' || n_regionkey, sum(round(total)::BIGINT)::BIGINT, false FROM z WHERE k % 9 <> 8 GROUP BY n_regionkey""")
def q_polygon_rollup(spark, sf_dir):
    leaves = _rows(spark, sf_dir).where("admin_level = 1")
    rolled = raster.roll_up(leaves.select("id").join(_sums(spark, sf_dir), "id", "left"), hierarchy.admin_ancestors(leaves).select("id", "ancestor"))
    return rolled.select("id", "quantity", "incomplete")


@query("SELECT 'r' || n_regionkey AS id, 2.0 * count(*) + 2 AS area, count(*)::VARCHAR AS children FROM nation GROUP BY n_regionkey")
def q_filled_boundaries(spark, sf_dir):
    """Regions filled by the union of their nations' boxes, each of which overlaps the next by half."""
    from pyspark.sql import Window

    n = views.table(spark, sf_dir, "nation")
    nth = (F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey")) - 1).cast("double")
    lines = n.select(_n().alias("seq"), _text('{"id":"n', _n(), '",', _bounded(_box(nth, F.lit(0.0), F.lit(2.0))), "}").alias("text"))
    units = places.flatten(lines).select("id", "geometry").join(n.select(_text("n", _n()).alias("id"), _text("r", F.col("n_regionkey")).alias("parent")), "id").withColumn("level", F.lit(2))
    top = views.table(spark, sf_dir, "region").select(_text("r", F.col("r_regionkey")).alias("id"), F.lit(None).cast("binary").alias("geometry"), F.lit(None).cast("string").alias("parent"), F.lit(1).alias("level"))
    filled, issues = mapping.missing_boundaries(units.unionByName(top), 3)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            area = [sum(geo.signed_area(ring) for polygon in geo.from_wkb(w)[1] for ring in polygon) for w in batch.column("geometry").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([round(a, 6) for a in area], pa.float64())], names=["id", "area"])

    areas = filled.where("level = 1 and geometry is not null").select("id", "geometry").mapInArrow(run, "id string, area double")
    return areas.join(issues.select(F.col("location_id").alias("id"), F.regexp_extract("detail", "([0-9]+)", 1).alias("children")), "id")


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'b' || s_suppkey END AS cell, CASE WHEN s_suppkey % 3 <> 0 THEN 5 END AS level FROM supplier""")
def q_deepest_cell(spark, sf_dir):
    def cell(scheme: str, level: int, value) -> object:
        return F.struct(F.lit(scheme).alias("scheme"), F.lit(level).alias("level"), value.alias("cell"))

    held = F.when(_s() % 3 == 0, F.array(cell("geohash", 9, _text("g")))).otherwise(F.array(cell("quadkey", 3, _text("x")), cell("quadkey", 5, _text("a", _s())), cell("geohash", 9, _text("g")), cell("quadkey", 5, _text("b", _s()))))
    found = cells.deepest(held, "quadkey")
    return views.table(spark, sf_dir, "supplier").select("s_suppkey", found["cell"].alias("cell"), found["level"].alias("level"))


@query("""WITH o AS (SELECT o_orderkey AS k FROM orders) SELECT k::VARCHAR AS id, CASE WHEN k % 3 = 0 THEN 'unchanged' WHEN k % 3 = 1 THEN 'changed' ELSE 'new' END AS change FROM o""")
def q_reports_compared(spark, sf_dir):
    """Documents of two runs by a hash of their content: dates, versions and the order of keys do not count, 1 and 1.0 differ."""
    from ..functions.documents import content_hash

    def hashed(rows: DataFrame) -> DataFrame:
        import json

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("scope"), pa.array([content_hash(json.loads(t)) for t in batch.column("text").to_pylist()], pa.string())], names=["id", "scope", "hash"])

        return rows.mapInArrow(run, "id string, scope string, hash string")

    k = F.col("o_orderkey")
    orders = views.table(spark, sf_dir, "orders").select(k.cast("string").alias("id"), F.lit("s").alias("scope"), k)
    before = orders.where(k % 3 != 2).select("id", "scope", _text('{"id":"', k, '","n":1,"m":2,"date":"2024-01-01","meta":{"versionId":"1"}}').alias("text"))
    now = orders.select("id", "scope", _text('{"m":2,"date":"2025-01-01","n":', F.when(k % 3 == 1, "1.0").otherwise("1"), ',"id":"', k, '","meta":{"lastUpdated":"x"}}').alias("text"))
    return merge.compare_runs(hashed(now), hashed(before), ["scope"])


@query(f"""WITH {_POINTS} SELECT CASE WHEN k % 9 = 8 THEN 'unknown' ELSE 'R' || n_regionkey END AS country, count(*)::BIGINT AS n FROM p WHERE x + dx BETWEEN -60 AND 20 AND y + dy BETWEEN -15 AND 10 GROUP BY ALL""")
def q_dataset_in_envelope(spark, sf_dir):
    from ..operators.reports import in_envelope

    back = in_envelope(geoparquet.read(spark, _dataset(spark, sf_dir)), -60, -15, 20, 10).where("type = 'facility'")
    return back.groupBy("country").agg(F.count("*").alias("n"))


@query(f"""WITH {_POINTS} SELECT 's' || s AS id, CASE WHEN k % 9 = 8 THEN '' ELSE 'r' || n_regionkey || ',' END || 'n' || k AS ancestors, '/' || CASE WHEN k % 9 = 8 THEN '' ELSE 'r' || n_regionkey || '/' END || 'n' || k || '/s' || s AS path FROM p""")
def q_dataset_paths(spark, sf_dir):
    back = geoparquet.read(spark, _dataset(spark, sf_dir)).where("type = 'facility'")
    return back.select("id", F.array_join("ancestor_ids", ",").alias("ancestors"), "path")


@query("""SELECT 'c' || c_custkey AS id, CASE WHEN c_custkey % 300 BETWEEN 0 AND (SELECT max(s_suppkey) FROM supplier) THEN CASE WHEN c_custkey % 300 % 2 = 0 THEN 'N' || c_custkey % 300 END END AS nhfr_code, CASE WHEN c_custkey % 300 NOT BETWEEN 0 AND (SELECT max(s_suppkey) FROM supplier) THEN 'organization_missing' WHEN c_custkey % 300 % 3 <> 0 THEN 'organization_name_mismatch' END AS issue FROM customer""")
def q_places_with_organizations(spark, sf_dir):
    k = F.col("c_custkey")
    rows = views.table(spark, sf_dir, "customer").select(_text("c", k).alias("id"), F.col("c_name").alias("name"), _text("o", k % 300).alias("managing_organization"), k.alias("seq"))
    text = _text('{"resourceType":"Organization","id":"o', _s(), '"', _member("name", F.when(_s() % 3 != 0, _quoted(F.col("s_name")))), _member("identifier", F.when(_s() % 2 == 0, _text('[{"system":"', P.identifier("nhfr-code"), '","value":"N', _s(), '"}]'))), "}")
    orgs = places.flatten_organizations(views.table(spark, sf_dir, "supplier").select(_s().alias("seq"), text.alias("text")))
    joined, issues = places.with_organizations(rows, orgs)
    return joined.select("id", "nhfr_code").join(issues.select(F.col("location_id").alias("id"), F.col("kind").alias("issue")), "id", "left")


@query(f"WITH {_POINTS} SELECT 's' || s AS id, 'n' || k AS ancestor, 0 AS distance FROM p UNION ALL SELECT 's' || s, 'r' || n_regionkey, 1 FROM p WHERE k % 9 <> 8")
def q_all_admin_ancestors(spark, sf_dir):
    return hierarchy.admin_ancestors(_rows(spark, sf_dir).where("type = 'facility'")).select("id", "ancestor", "distance")


@query("SELECT 'https://registry.example.org/' || lower(p_type) AS url FROM part GROUP BY p_type")
def q_distinct_addresses(spark, sf_dir):
    """Addresses of boundaries that are to be fetched, each once."""
    at = _text("https://registry.example.org/", F.lower("p_type"))
    lines = views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("seq"), _text('{"id":"p', F.col("p_partkey"), '","extension":[{"url":"', P.boundaries[0], '","valueAttachment":{"contentType":"application/geo+json","url":"', at, '"}}]}').alias("text"))
    return places.flatten(lines).select(F.col("boundary_url").alias("url")).distinct()


@query("SELECT 'p' || p_partkey AS id, p_size AS quantity FROM part WHERE p_partkey % 3 = 0 OR p_size > 25")
def q_stream_merge(spark, sf_dir):
    """Two batches through the stream's merge: the later one replaces what it names."""
    from ..streaming import incremental

    path, k = folder(spark), F.col("p_partkey")
    parts = views.table(spark, sf_dir, "part")
    old = parts.where((k % 3 == 0) | (F.col("p_size") > 25)).select(_text('{"id":"p', k, '","q":', F.when(k % 2 == 0, -1).otherwise(F.col("p_size")), "}").alias("text"))
    new = parts.where(((k % 3 == 0) | (F.col("p_size") > 25)) & (k % 2 == 0)).select(_text('{"id":"p', k, '","q":', F.col("p_size"), "}").alias("text"))
    for n, batch in enumerate((old, new)):
        incremental.merge_batch(batch, n, path)
    return incremental.current(spark, path).select("id", F.get_json_object("text", "$.q").cast("int").alias("quantity"))
