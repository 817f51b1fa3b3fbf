"""Edited rows against the snapshot: nothing changes without an edit, and each kind of edit changes its own part alone."""

import json

import pytest

from atlasloom.functions import geometry as geo
from atlasloom.functions.documents import Profile, content_hash, references
from atlasloom.functions.patches import COMPUTED
from atlasloom.operators import edits

from .registry import ISLANDS, P, square

ORGS = [{"resourceType": "Organization", "id": "firm", "name": "Firm", "active": True}]


@pytest.fixture(scope="module")
def base(spark):
    shape = "id string, text string, seq long"
    return tuple(spark.createDataFrame([(r["id"], json.dumps(r), i) for i, r in enumerate(rows)], shape) for rows in (ISLANDS, ORGS))


def changes(spark, base, features, organizations=True):
    frame = spark.createDataFrame([(i, json.dumps(f.get("properties", {})), json.dumps(f["geometry"]) if f.get("geometry") else None, f.get("id")) for i, f in enumerate(features)], "seq long, properties string, geometry string, feature_id string")
    got = edits.changed_documents(edits.rows_of_features(frame), base[0], base[1] if organizations else None).orderBy("seq").collect()
    return [(r["action"], r["location"] and json.loads(r["location"]), r["organization"] and json.loads(r["organization"]), [i["kind"] for i in r["issues"]]) for r in got]


def by_id(key):
    return next(r for r in ISLANDS if r["id"] == key)


def test_no_edit_is_no_change(spark, base):
    rows = [{"properties": {"id": r["id"], "name": r["name"], "admin1_name": "ignored", "alias": [], "description": ""}} for r in ISLANDS]
    assert [c[:3] for c in changes(spark, base, rows)] == [("unchanged", None, None)] * len(ISLANDS)


def test_edits(spark, base):
    got = changes(spark, base, [
        {"properties": {"id": "isl", "name": "Islands", "pcode": ""}}, {"properties": {"id": "ward", "status": "inactive", "part_of": "north", "position_longitude": "13.75"}}, {"properties": {"id": "north"}, "geometry": square(12, -4, 20.00000001, 4)},
        {"properties": {"id": "reef"}, "geometry": square(16, 0, 19, 2)}, {"properties": {"id": "cove"}, "geometry": {"type": "Point", "coordinates": [1, 2]}}, {"properties": {"id": "isl", "name": "again"}},
        {"properties": {"name": "New", "type": "facility", "position_longitude": 1, "position_latitude": 2}}, {"properties": {"id": "lost", "position_latitude": None, "name": 5}}, {"properties": {"id": "waif"}, "geometry": {"type": "Point", "coordinates": [14.5, 1, 9]}},
    ])
    assert got[0][1] == {k: v for k, v in by_id("isl").items() if k != "identifier"} | {"name": "Islands"}
    assert got[1][1]["partOf"] == {"reference": "Location/north"} and got[1][1]["position"] == {"longitude": 13.75, "latitude": 0.6}
    assert got[1][2] == ORGS[0] | {"active": False}
    assert got[2][:2] == ("unchanged", None)
    assert geo.parse_boundary(__import__("base64").b64decode(got[3][1]["extension"][0]["valueAttachment"]["data"]))[0][1][0][0][1] == (19.0, 0.0)
    assert got[4] == ("unchanged", None, None, ["geometry_kind_changed"])
    assert got[5][0] == "skipped" and got[5][3] == ["duplicate_id"]
    assert got[6][0] == "created" and got[6][2]["id"] == "org-" + got[6][1]["id"] and got[6][3] == ["new_location_generated_id"]
    assert got[7][3] == ["input_column_type", "input_column_type", "organization_missing"]
    assert got[8][1]["position"] == {"longitude": 14.5, "latitude": 1.0} and got[8][3] == ["boundary_z_dropped"]


def test_cells_are_backfilled_and_follow_the_position(spark, base):
    lines = base[0].select("seq", "text")
    done = edits.backfill_cells(lines, [("quadkey", 18), ("geohash", 4)]).collect()
    assert {r["id"]: r["status"] for r in done}["ward"] == "indexed" and {r["status"] for r in done} == {"indexed", "no_position"}
    ward = json.loads(next(r["text"] for r in done if r["id"] == "ward"))
    cells = [edits.patches.cell_of(e) for e in ward["extension"]]
    assert cells == [{"scheme": "quadkey", "level": 18, "cell": COMPUTED["quadkey"](13.6, 0.6, 18)}, {"scheme": "geohash", "level": 4, "cell": COMPUTED["geohash"](13.6, 0.6, 4)}]
    again = edits.backfill_cells(spark.createDataFrame([(0, json.dumps(ward))], "seq long, text string"), [("quadkey", 18)], refresh=True).first()
    assert again["status"] == "already_indexed"
    moved = edits.patches.rebuild(ward, {"position_longitude": 50.0, "position_latitude": 1.0}, None, Profile(), print)
    assert edits.patches.cell_of(moved["extension"][1])["cell"] == COMPUTED["geohash"](50.0, 1.0, 4)
    assert "extension" not in edits.patches.rebuild(ward, {"position_longitude": None, "position_latitude": None}, None, Profile(), print)


def test_known_cells():
    assert COMPUTED["geohash"](10.40744, 57.64911, 11) == "u4pruydqqvj"
    assert COMPUTED["quadkey"](-90, 45, 1) == "0" and COMPUTED["quadkey"](90, -45, 1) == "3"
    assert COMPUTED["quadkey"](9.9, 10.5, 18).startswith(COMPUTED["quadkey"](9.9, 10.5, 7))


def test_hash_and_references():
    a = {"id": "x", "date": "1", "meta": {"versionId": "1", "tag": 1}, "n": 1}
    assert content_hash(a) == content_hash({"n": 1, "id": "x", "meta": {"tag": 1, "lastUpdated": "z"}})
    assert content_hash(a) != content_hash(a | {"n": 1.0})
    assert references({"a": {"reference": "Location/x/_history/3"}, "b": [{"reference": "http://h/Organization/y"}, {"reference": "#local"}]}) == ["Location/x", "Organization/y"]
    assert P.pcodes[0].endswith("/pcode")
