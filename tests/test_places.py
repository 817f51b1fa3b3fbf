"""From document lines to a partitioned dataset, over a registry with a case in every line."""

import json

import pyarrow.parquet as pq
import pytest

from atlasloom.functions import geometry as geo
from atlasloom.operators import places
from atlasloom.sources import files, geoparquet

from .registry import COUNTS, ISLANDS, P, square


@pytest.fixture(scope="module")
def flat(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("snapshot") / "locations.ndjson"
    path.write_text("﻿" + "\n\n".join(json.dumps(r) for r in ISLANDS) + "\n")
    return places.flatten(files.read_lines(spark, str(path)))


def test_registry(spark, flat, tmp_path):
    rows, issues = places.located(flat)
    got = {r["id"]: r for r in rows.collect()}
    assert set(got) == {"isl", "north", "cove", "reef", "quay", "ward", "lost", "waif"}
    assert {r["kind"]: r["n"] for r in issues.groupBy("kind").count().withColumnRenamed("count", "n").collect()} == COUNTS
    assert [r["detail"] for r in issues.where("kind = 'duplicate_pcode'").collect()] == ["cove, reef"]
    ward = got["ward"]
    assert (ward["admin1_name"], ward["admin2_name"], ward["country"], ward["tier"], ward["depth"]) == ("The north", "The cove", "IS", "site", 4)
    assert ward["path"] == "/isl/north/cove/quay/ward"
    assert got["waif"]["country"] == "unknown" and got["reef"]["admin_level"] == 2
    assert "extension" not in json.loads(got["isl"]["fhir_json"])
    assert [r["location_id"] for r in places.outside_parent(rows).collect()] == ["lost"]
    out = str(tmp_path / "out")
    for _ in range(2):  # a second run replaces the first
        manifest = geoparquet.write(rows.drop("chain", "seq"), out)
    assert [m["folder"] for m in manifest[:-1]] == ["country=IS/geom_type=point/type=facility", "country=IS/geom_type=polygon/type=admin-unit", "country=IS/geom_type=polygon/type=settlement", "country=unknown/geom_type=point/type=facility"]
    back = geoparquet.read(spark, out)
    assert back.count() == 8 and back.where("id = 'ward' and country = 'IS'").count() == 1
    meta = json.loads(pq.read_metadata(f"{out}/country=IS/geom_type=polygon/type=admin-unit/part-0.parquet").metadata[b"geo"])
    assert meta["columns"]["geometry"]["bbox"] == [10, -10, 30, 10] and meta["columns"]["geometry"]["geometry_types"] == ["Polygon"]
    seen = geoparquet.inspect(spark, out).collect()
    assert sum(r["rows"] for r in seen) == 8 and [r["file"] for r in seen] == geoparquet.files(out)


def test_files_hold_stretches_of_the_curve(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(geoparquet, "ROWS_IN_FILE", 100)
    box = "struct<xmin:double,ymin:double,xmax:double,ymax:double>"
    rows = spark.range(600).selectExpr("cast(id as string) as id", "if(id < 550, 'a', 'b') as country", "'point' as geom_type", "'t' as type", "cast(pmod(id * 7919, 65536) as bigint) as hilbert", f"cast(named_struct('xmin', id, 'ymin', id, 'xmax', id, 'ymax', id) as {box}) as bbox", "unhex('0101000000') as geometry")
    manifest = geoparquet.write(rows, str(tmp_path / "d"), rows_in_group=40)[:-1]
    assert sum(m["rows"] for m in manifest) == 600 and {m["folder"] for m in manifest} == {"country=a/geom_type=point/type=t", "country=b/geom_type=point/type=t"}
    spans = []
    for m in manifest:
        file = pq.ParquetFile(f"{tmp_path}/d/{m['folder']}/part-{m['file']}.parquet")
        keys = file.read(["hilbert"]).column(0).to_pylist()
        assert keys == sorted(keys) and all(file.metadata.row_group(i).num_rows == 40 for i in range(file.metadata.num_row_groups - 1))
        spans.append((m["folder"], keys[0], keys[-1]))
    own = sorted(s for s in spans if "country=a" in s[0])
    assert 4 <= len(own) <= 9 and all(a[2] <= b[1] for a, b in zip(own[:-1], own[1:], strict=True))


def test_given_country(flat):
    rows, issues = places.located(flat, country="XX")
    assert {r["country"] for r in rows.collect()} == {"XX"}
    assert issues.where("kind = 'no_country'").count() == 0


def test_organizations(spark, flat):
    lines = [{"resourceType": "Organization", "id": "firm", "name": "Other", "identifier": [{"system": P.identifier("nhfr-code"), "value": "7"}], "type": [{"coding": [{"system": P.codes("ownership"), "code": "p"}], "text": "Public"}]}, {"resourceType": "Organization", "id": "firm", "name": "Later"}, {"id": 3}]
    orgs = places.flatten_organizations(spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(lines)], "seq long, text string"))
    rows, issues = places.with_organizations(places.located(flat)[0], orgs)
    assert {(r["kind"], r["location_id"]) for r in issues.collect()} == {("organization_name_mismatch", "ward"), ("organization_missing", "lost")}
    assert rows.where("id = 'ward'").select("nhfr_code", "ownership_text").first() == ("7", "Public")


def test_unusable_lines(spark):
    bad = ["{", "[]", '{"name":"x"}', '{"id":""}', '{"id":5}', '{"id":"a","resourceType":"Patient"}', '{"id":"b","alias":"x","identifier":{},"meta":1,"partOf":{"reference":"Location/"},"position":{"longitude":"1"},"extension":[3]}']
    flat = places.flatten(spark.createDataFrame(list(enumerate(bad)), "seq long, text string")).collect()
    assert [r["id"] for r in flat] == [None] * 6 + ["b"]
    assert [r["issues"][0]["kind"] for r in flat] == ["malformed_field", "malformed_field", "missing_id", "missing_id", "malformed_field", "malformed_field", "malformed_field"]
    assert [i["kind"] for i in flat[6]["issues"]] == ["malformed_field"] * 6 + ["no_geometry"]


def test_pretty_printed_input_is_refused(spark, tmp_path):
    (tmp_path / "a.ndjson").write_text('{\n"id": "a"\n}')
    with pytest.raises(ValueError, match="pretty-printed"):
        files.read_lines(spark, str(tmp_path / "a.ndjson"))


def test_bundles_and_features(spark, tmp_path):
    (tmp_path / "b.ndjson").write_text(json.dumps({"resourceType": "Bundle", "entry": [{"resource": {"id": "x", "z": 1, "a": 2}}, {}]}) + '\n{"id":"y"}\n')
    got = files.expand_bundles(files.read_lines(spark, str(tmp_path / "b.ndjson"))).orderBy("seq").collect()
    assert [r["text"] for r in got] == ['{"id":"x","z":1,"a":2}', '{"id":"y"}']
    feature = {"type": "Feature", "id": 4, "properties": {"name": "é"}, "geometry": {"type": "Point", "coordinates": [1, 2]}}
    (tmp_path / "f.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [feature, {"type": "Feature", "geometry": None}]}, indent=1))
    (tmp_path / "f.geojsonl").write_text(json.dumps(feature) + "\n")
    assert [(r["feature_id"], json.loads(r["properties"])) for r in files.read_features(spark, str(tmp_path / "f.geojson")).orderBy("seq").collect()] == [("4", {"name": "é"}), (None, {})]
    assert files.read_features(spark, str(tmp_path / "f.geojsonl")).count() == 1
    (tmp_path / "r.csv").write_text('﻿id,name\n1,"a, b"\n02,\n')
    assert [tuple(r) for r in files.read_rows(spark, str(tmp_path / "r.csv")).collect()] == [("1", "a, b"), ("02", None)]
    wide = json.dumps({"headers": [{"name": n} for n in ("pe", "dx", "value", "ou", "breakdown")], "rows": [["202501", "d", "3", "u", "opt"]]})
    assert tuple(files.read_analytics(spark.createDataFrame([(wide,)], "text string")).first()) == ("d", "202501", "u", "3", "", "", "opt")


def test_collisions_of_folder_names():
    folders, issues = geoparquet.place_folders([(("a/b", "a_b"),), (("a:b", "a_b"),), (("A_B", "A_B"),), ((None, "null"),), (("null", "null"),)], ["type"])
    assert len({f.lower() for f in folders.values()}) == 4
    assert folders[(("a/b", "a_b"),)] == "type=a_b" and folders[((None, "null"),)] == folders[(("null", "null"),)]
    assert [i["kind"] for i in issues].count("partition_value_collision") == 2


def test_geometry():
    hole = [(4, 4), (4, 6), (6, 6), (6, 4), (4, 4)]
    ring = [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]
    shape = ("polygon", [[[tuple(map(float, p)) for p in ring], [tuple(map(float, p)) for p in hole]]])
    assert geo.intersects(shape, [5, 1, 0, 11, 4], [5, 1, 5, 5, 5]).tolist() == [False, True, True, False, True]
    assert geo.from_wkb(geo.to_wkb(shape)) == shape and geo.from_wkb(geo.to_wkb(("point", (1.0, 2.0)))) == ("point", (1.0, 2.0))
    assert geo.intersects(shape, *geo.interior_point(shape))[0]
    assert geo.invalid(shape) is None
    assert geo.invalid(("polygon", [[[(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]]])) == "ring crosses itself"
    assert geo.invalid(("polygon", [[[(0, 0), (1, 1), (0, 0)]]])) and geo.invalid(("polygon", [[[(0, 0), (1, 1), (0, 0), (0, 0)]]]))
    left, right = (geo.from_geojson(square(x, 0, x + 1, 1))[0] for x in (0, 1))
    both = geo.union([left, right])
    assert both[0] == "polygon" and geo.signed_area(both[1][0][0]) == 2
    assert geo.union([left, geo.from_geojson(square(5, 5, 6, 6))[0]])[0] == "multipolygon"
    assert geo.rounded(("point", (0.12345675, -0.12345675)))[1] == (0.1234568, -0.1234568)
    assert geo.zonal_spans(geo.edges(left), 0.5, -0.5, 0.5, 10) == [(1, 2)]
    wide, issues = geo.parse_boundary(json.dumps({"type": "FeatureCollection", "features": [{"geometry": square(0, 0, 1, 1)}, {"geometry": {"type": "Point", "coordinates": [1, 2, 3]}}]}).encode())
    assert wide[0] == "multipolygon" and [k for k, _ in issues] == ["boundary_multi_feature", "boundary_z_dropped", "boundary_part_dropped"]


def area(shape):
    return 0 if shape is None else sum(geo.signed_area(ring) for polygon in shape[1] for ring in polygon)


def boxes(*bounds):
    return [geo.from_geojson(square(*b))[0] for b in bounds]


def test_unions_and_repairs():
    assert area(geo.union(boxes((0, 0, 4, 4), (2, 2, 6, 6)))) == pytest.approx(28)
    assert area(geo.union(boxes((0, 0, 4, 4), (1, 1, 2, 2)))) == 16 and area(geo.union(boxes((0, 0, 4, 4), (4, 1, 6, 2)))) == pytest.approx(18)
    ringed = geo.union(boxes((0, 0, 6, 1), (0, 5, 6, 6), (0, 0, 1, 6), (5, 0, 6, 6)))
    assert ringed[0] == "polygon" and len(ringed[1][0]) == 2 and area(ringed) == pytest.approx(20)
    assert geo.union([]) is None and area(geo.union(boxes((0, 0, 1, 1), (0, 0, 1, 1)))) == 1
    bow = ("polygon", [[[(0.0, 0.0), (2.0, 2.0), (2.0, 0.0), (0.0, 2.0), (0.0, 0.0)]]])
    mended = geo.repaired(bow)
    assert geo.invalid(bow) and geo.invalid(mended) is None and mended[0] == "multipolygon" and area(mended) == pytest.approx(2)


def test_validity_of_large_rings_is_quick():
    import math
    import time

    for n, turn in ((20_000, 2 * math.pi), (40_000, math.pi)):  # a circle, and half a disc with its long straight side
        ring = [(math.cos(0.3 + turn * i / n), math.sin(0.3 + turn * i / n)) for i in range(n)]
        crossed = [*ring[: n // 2], (0.9, 0.9), (-2.0, -2.0), *ring[n // 2 :]]
        t = time.time()
        assert geo.invalid(("polygon", [[[*ring, ring[0]]]])) is None
        assert time.time() - t < 2
        assert geo.invalid(("polygon", [[[*crossed, crossed[0]]]])) == "ring crosses itself"


def test_curve_keys_agree(spark):
    from pyspark.sql import functions as F

    from atlasloom.functions import cells

    points = [(x * 0.37 - 181, y * 1.9 - 91) for x in range(0, 980, 13) for y in range(0, 97, 5)] + [(None, 1.0), (0.0, 0.0), (180.0, 90.0), (-180.0, -90.0)]
    frame = spark.createDataFrame(points, "x double, y double")
    want = [r[0] for r in frame.select(cells.hilbert_key(F.col("x"), F.col("y"))).collect()]
    assert cells.hilbert_keys([p[0] for p in points], [p[1] for p in points]).tolist() == want
