"""The dataflows from files to files."""

import json

import numpy as np
import pytest

from atlasloom import cli
from atlasloom.plans import dataflows
from atlasloom.sources import geoparquet, geotiff

from .registry import COUNTS, ISLANDS
from .test_sources_and_rasters import server  # noqa: F401


@pytest.fixture()
def snapshot(tmp_path):
    path = tmp_path / "snapshot"
    path.mkdir()
    (path / "locations.ndjson").write_text("".join(json.dumps(r) + "\n" for r in ISLANDS))
    return str(path)


def test_transform_diff_and_load(spark, snapshot, tmp_path):
    out = str(tmp_path / "out")
    report = dataflows.transform(spark, snapshot, out)
    assert (report["read"], report["written"], report["partitions"]) == (14, 8, 4)
    assert report["counts"] == COUNTS | {"point_outside_parent": 1, "small_partition": 4}
    assert [i["location_id"] for i in report["issues"] if i["kind"] == "no_geometry"] == ["buoy", "fog", "tail"]  # in file order
    assert json.load(open(f"{out}/_report.json"))["written"] == 8
    assert dataflows.inspect(spark, out)["rows"] == 8
    assert dataflows.diff(spark, snapshot, out + "/country=IS/geom_type=polygon/type=admin-unit/part-0.parquet", str(tmp_path / "none.ndjson"))["actions"] == {"unchanged": 4}
    feature = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"id": i, "name": "New"}, "geometry": None} for i in ("ward", "isl", "north")]}
    (tmp_path / "e.geojson").write_text(json.dumps(feature))
    changed = str(tmp_path / "c.ndjson.gz")
    assert dataflows.diff(spark, snapshot, str(tmp_path / "e.geojson"), changed)["written"] == 3
    plan = dataflows.load(spark, changed, dry_run=True, batch_size=1)
    assert plan == {"plan": [(0, "create Location/ward"), (1, "create Location/isl"), (2, "create Location/north")], "needs": {2: [1]}}
    with pytest.raises(ValueError):
        dataflows.transform(spark, snapshot, out, partition_by="name")
    assert geoparquet.read(spark, out).count() == 8


def test_extract_pulls_what_is_new(spark, server, tmp_path):  # noqa: F811
    url, state = server
    path = str(tmp_path / "pulled")
    state_before = dataflows.extract.__doc__
    assert state_before
    with pytest.raises(Exception):
        dataflows.extract(spark, f"{url}/fhir", path, retries=0)  # this server has no organizations
    assert [json.loads(x)["id"] for x in open(f"{path}/locations.ndjson")] == ["a", "b", "c"]
    got = dataflows.export(spark, f"{url}/fhir", ["Location"], str(tmp_path / "all.ndjson"))
    assert got == {"written": 3, "Location": 3}


def test_index_and_population(spark, snapshot, tmp_path):
    report = dataflows.index(spark, snapshot, ["quadkey:18"], str(tmp_path / "i.ndjson"))
    assert report["counts"] == {"indexed": 7, "no_position": 7} and report["written"] == 7
    values = np.full((20, 20), 3, np.float32)
    geotiff.write_grid(str(tmp_path / "p.tif"), values, 10.0, 10.0, 1.0, -1)
    got = dataflows.population(spark, snapshot, str(tmp_path / "p.tif"), 1, 2025, str(tmp_path / "g.ndjson"))
    groups = {json.loads(x)["id"]: json.loads(x)["quantity"] for x in open(tmp_path / "g.ndjson")}
    assert groups == {"worldpop-north-2025": 192, "worldpop-isl-2025": 192} and got["raster_total"] == 1200


def test_command_line(snapshot, tmp_path, capsys, monkeypatch, spark):
    monkeypatch.setattr(cli, "local_session", lambda: spark)
    assert cli.main(["index", "--snapshot", snapshot, "--cells", "geohash:4", "--out", str(tmp_path / "i.ndjson")]) == 0
    assert json.loads(capsys.readouterr().out)["written"] == 7
    assert cli.main(["index", "--snapshot", snapshot, "--cells", "h3:4", "--out", "x"]) == 2
