"""REST paging and loading against a local server, rasters with known sums, builders, streams and planning."""

import http.server
import json
import threading
from datetime import date

import numpy as np
import pytest

from atlasloom.functions import expressions, periods
from atlasloom.functions import geometry as geo
from atlasloom.operators import bake, builders, facts, raster
from atlasloom.sources import geotiff, rest
from atlasloom.streaming import incremental


@pytest.fixture()
def server():
    state = {"calls": [], "fail": 0, "posted": []}

    class Handler(http.server.BaseHTTPRequestHandler):
        def answer(self, status, body):
            raw = json.dumps(body).encode()
            self.send_response(status)
            self.send_header("Content-Length", str(len(raw)))
            self.end_headers()
            self.wfile.write(raw)

        def do_GET(self):
            state["calls"].append(self.path)
            if state["fail"]:
                state["fail"] -= 1
                return self.answer(503, {})
            if self.path.startswith("/fhir/Location?page=2"):
                return self.answer(200, {"resourceType": "Bundle", "entry": [{"resource": {"id": "c"}}]})
            if self.path.startswith("/fhir/Location?_summary"):
                return self.answer(200, {"total": 3})
            if self.path.startswith("/fhir/Location?"):
                return self.answer(200, {"resourceType": "Bundle", "entry": [{"resource": {"id": "a"}}, {"resource": {"id": "b"}}, {}], "link": [{"relation": "next", "url": "Location?page=2"}]})
            if self.path.startswith("/fhir/Loop"):
                return self.answer(200, {"resourceType": "Bundle", "link": [{"relation": "next", "url": self.path}]})
            if self.path == "/b":
                return self.answer(200, {"boundary": 1})
            return self.answer(404, {"no": self.path})

        def do_POST(self):
            state["posted"].append(json.loads(self.rfile.read(int(self.headers["Content-Length"]))))
            self.answer(200, {})

        def log_message(self, *args):
            pass

    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}", state
    s.shutdown()


def test_paging_and_retries(spark, server):
    url, state = server
    client = rest.Client(f"{url}/fhir", pause=0.01)
    state["fail"] = 2
    assert [(r and r["id"], i) for r, i in rest.search(client, "Location", "2024-01-01T00:00:00Z")] == [("a", None), ("b", None), (None, "page_resource_skipped"), ("c", None)]
    assert "_lastUpdated=ge2024" in state["calls"][0] and rest.count(client, "Location") == 3
    with pytest.raises(ValueError, match="does not end"):
        list(rest.search(client, "Loop"))
    with pytest.raises(rest.Refused):
        client.get("nothing")
    spark.dataSource.register(rest.Search)
    got = spark.read.format("fhir_search").option("server", f"{url}/fhir").option("types", "Location").load()
    assert [r["text"] for r in got.orderBy("seq").collect()] == ['{"id":"a"}', '{"id":"b"}', None, '{"id":"c"}']


def test_boundaries_are_cached(server, tmp_path):
    url, state = server
    client, cache = rest.Client(url, pause=0.01, retries=0), rest.Cache(str(tmp_path))
    assert [(u, r is not None, bool(i)) for u, r, i in rest.fetch_all([f"{url}/b", f"{url}/b", f"{url}/none"], client, cache)] == [(f"{url}/b", True, False), (f"{url}/none", False, True)]
    calls = len(state["calls"])
    assert next(rest.fetch_all([f"{url}/b"], client, cache))[1] and len(state["calls"]) == calls
    state["fail"] = 1
    assert next(rest.fetch_all([f"{url}/b"], client, cache, refresh=True))[2] == "boundary_stale_from_cache"
    with pytest.raises(rest.Broken):
        list(rest.fetch_all([f"{url}/x{i}" for i in range(5)], client, breaker=3))


def test_loading_in_order(server):
    url, state = server
    client = rest.Client(url)
    bundles = {0: [{"resourceType": "Location", "id": "a", "meta": {"versionId": "2"}}], 1: [{"resourceType": "Location", "id": "b"}], 2: [{"resourceType": "Location", "id": "c"}]}
    order = rest.post_all(bundles, {1: {2}, 2: {0}}, lambda rs: client.call("", rest.transaction(rs)), workers=3)
    assert order == [0, 2, 1] and state["posted"][0]["entry"][0]["request"] == {"method": "PUT", "url": "Location/a", "ifMatch": 'W/"2"'}
    with pytest.raises(ValueError, match="wait for one another"):
        rest.post_all({0: [], 1: []}, {0: {1}, 1: {0}}, print)
    assert rest.preflight({"rest": [{"resource": [{"type": "Location", "updateCreate": True}]}]}, {"Location", "Organization"}) == ["Organization: updateCreate is not stated"]
    with pytest.raises(ValueError):
        rest.preflight({"rest": [{"resource": [{"type": "Location", "updateCreate": False}]}]}, {"Location"})


def test_raster_sums(spark, tmp_path):
    rows, columns = 24, 36
    values = ((np.arange(rows)[:, None] * 37 + np.arange(columns) * 11) % 101 - 4).astype(np.float32)  # some are negative
    holes = np.zeros((rows, columns), bool)
    holes[[2, 11, 23], [35, 0, 17]] = True
    values[holes] = -77
    path = str(tmp_path / "r.tif")
    geotiff.write_grid(path, values, -4.0, 3.0, 0.25, -77, tile=16)
    grid, tiles = geotiff.read_grid(path), geotiff.tiles(spark, path)
    assert (grid.width, grid.height, grid.nodata, grid.tile) == (columns, rows, -77, (16, 16))
    counted = np.where(holes, 0, np.maximum(values, 0)).astype(float)
    assert tuple(raster.grand_total(tiles, grid.nodata).first()) == (counted.sum(), rows * columns - 3)

    def box(key, x0, y0, x1, y1):
        shape = ("polygon", [[[(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]]])
        return key, geo.to_wkb(shape), dict(zip(("xmin", "ymin", "xmax", "ymax"), map(float, geo.bbox(shape)), strict=True))

    # columns 0 to 13 and 14 to 35 over all rows; an edge through the middle of a pixel gives it to the east
    polygons = spark.createDataFrame([box("left", -4.0, -3.0, -0.375, 3.0), box("right", -0.375, -3.0, 5.0, 3.0), box("away", 90.0, 4.0, 91.0, 5.0)], "id string, geometry binary, bbox struct<xmin:double,ymin:double,xmax:double,ymax:double>")
    sums = raster.polygon_sums(tiles, polygons, grid)
    left, right = counted[:, :14].sum(), counted[:, 14:].sum()
    assert {r["id"]: r["total"] for r in sums.collect()} == {"left": left, "right": right}
    above = spark.createDataFrame([("left", "top"), ("right", "top"), ("away", "top")], "id string, ancestor string")
    rolled = raster.roll_up(polygons.select("id").join(sums, "id", "left"), above)
    assert {r["id"]: (r["quantity"], r["incomplete"]) for r in rolled.collect()}["top"] == (int(left + right), True)
    groups, issues = builders.population_groups(rolled, "src", 2025)
    assert {r["id"] for r in groups.collect()} == {"src-left-2025", "src-right-2025", "src-top-2025"}
    assert json.loads(groups.where("id = 'src-top-2025'").first()["json"])["quantity"] == int(left + right)
    assert {(r["kind"], r["location_id"]) for r in issues.collect()} == {("no_boundary", "away"), ("rollup_incomplete", "top")}
    (tmp_path / "x.tif").write_bytes(b"nothing")
    with pytest.raises(ValueError):
        geotiff.read_grid(str(tmp_path / "x.tif"))


def lzw(raw):
    """An encoder that restarts its table now and then."""
    bits, table, size, last = "", {}, 9, b""

    def put(code):
        nonlocal bits
        bits += format(code, f"0{size}b")

    def fresh():
        nonlocal table, size
        put(256)
        table, size = {bytes([b]): b for b in range(256)}, 9

    fresh()
    for b in raw:
        if last + bytes([b]) in table:
            last += bytes([b])
            continue
        put(table[last])
        table[last + bytes([b])] = len(table) + 2
        size = max(9, min(12, (len(table) + 2).bit_length()))
        last = bytes([b])
        if len(table) > 4000:
            put(table[last])
            last = b""
            fresh()
    if last:
        put(table[last])
    put(257)
    return bytes(int(bits[i : i + 8].ljust(8, "0"), 2) for i in range(0, len(bits), 8))


def test_packed_rasters_are_read(tmp_path):
    values = (np.arange(16)[:, None] * 3.5 + np.arange(16) % 7).astype("<f4")
    plain = values.tobytes()
    assert geotiff._lzw(lzw(plain * 30)) == plain * 30 and geotiff._packed(bytes([2, 1, 2, 3, 254, 9, 128, 0, 7])) == b"\x01\x02\x03\x09\x09\x09\x07"
    planes = values.astype(">f4").view(np.uint8).reshape(16, 16, 4).transpose(0, 2, 1).reshape(16, 64)
    third = np.diff(planes, axis=1, prepend=np.uint8(0)).astype(np.uint8).tobytes()
    second = np.diff(values.view(np.uint32), axis=1, prepend=np.uint32(0)).astype("<u4").tobytes()
    for k, (body, compression, predictor) in enumerate([(plain, 1, 1), (lzw(plain), 5, 1), (lzw(third), 5, 3), (second, 1, 2)]):
        (tmp_path / f"{k}.bin").write_bytes(body)
        grid = geotiff.Grid(str(tmp_path / f"{k}.bin"), 16, 16, 0, 0, 1, 1, None, (16, 16), [0], [len(body)], compression, "<", predictor)
        assert (geotiff.read_tile(grid, 0) == values).all()


def test_builders(spark):
    found = builders.measures(spark.createDataFrame([("a_b", "n", "#{x}", "1", 1.0), ("c", "n", "#{x}", "#{y}", 100.0)], "id string, name string, numerator string, denominator string, factor double")).collect()
    assert [(r["id"], r["scoring"]) for r in found] == [("measure-a-b", "cohort"), ("measure-c", "proportion")]
    values = spark.createDataFrame([("i", "s", date(2025, 1, 1), date(2025, 1, 31), 5.0, 10.0, 50.0, 100.0)], "indicator string, subject string, start date, end date, numerator double, denominator double, value double, factor double")
    strata = spark.createDataFrame([("i", "s", date(2025, 1, 1), "b", 2), ("i", "s", date(2025, 1, 1), "a", 3)], "indicator string, subject string, start date, label string, count int")
    report = json.loads(builders.reports(values, strata).first()["json"])
    assert report["group"][0]["measureScore"]["value"] == 0.5 and [s["value"]["text"] for s in report["group"][0]["stratifier"][0]["stratum"]] == ["a", "b"]
    units = spark.createDataFrame([("C", "Country", "Country", 1, None, None, None, None), ("F", "Fac", "F.", 3, "C", "2024-01-01", 1.0, 2.0)], "id string, name string, shortName string, level int, parent string, closedDate string, longitude double, latitude double")
    docs = builders.unit_places(units, 3, "x-").orderBy("level", "unit", "place").collect()
    assert [r["id"] for r in docs] == ["x-C", "org-x-F", "x-F"] and json.loads(docs[2]["json"])["status"] == "inactive"


def test_periods(spark):
    table = {
        "2019": ("2019-01-01", "2019-12-31"), "202311": ("2023-11-01", "2023-11-30"), "200002": ("2000-02-01", "2000-02-29"), "20240229": ("2024-02-29", "2024-02-29"), "202306B": ("2023-11-01", "2023-12-31"), "2024Q3": ("2024-07-01", "2024-09-30"),
        "2022S1": ("2022-01-01", "2022-06-30"), "2021W1": ("2021-01-04", "2021-01-10"), "2020W53": ("2020-12-28", "2021-01-03"), "2024W9": ("2024-02-26", "2024-03-03"),
    } | dict.fromkeys(["2024W53", "THIS_YEAR", "2024July", "2023BiW2", "2023SunW3", "202300", "20230229", "2024Q0", "202307B", ""], (None, None))
    from pyspark.sql import functions as F

    got = spark.createDataFrame([(c,) for c in table], "c string").select("c", periods.period_start(F.col("c")).cast("string"), periods.period_end(F.col("c")).cast("string"), periods.period_kind(F.col("c")))
    assert {r[0]: (r[1], r[2]) for r in got.collect()} == table
    assert {r[0]: r[3] for r in got.collect()}["2021W1"] == "4W#"
    assert periods.parse_age("2w") == 1209600 and periods.parse_range("2025-01-01..2025-01-31") == ("2025-01-01", "2025-01-31")


def test_expressions(spark):
    from pyspark.sql import functions as F

    a, b = expressions.Item("a"), expressions.Item("b", None, "t")
    columns = {a: F.col("a"), b: F.col("b")}
    rows = spark.createDataFrame([(4.0, 2.0), (4.0, None), (None, None), (1.0, 0.0)], "a double, b double")

    def run(text, constants=None):
        return [r[0] for r in rows.select(expressions.evaluate(expressions.parse(text), columns, constants)).collect()]

    assert run("-#{a} + 2 * (#{b.*.t} - 1) / 4") == [-3.5, -4.5, None, -1.5]
    assert run("#{a} / #{b.*.t}") == [2.0, None, None, None]
    assert run("1 + 2") == [3.0] * 4 and run("C{k} * #{a}", {"k": 2.0})[0] == 8.0 and run("C{z} * #{a}") == [None] * 4
    for bad in ("#{a", "1 +", "(1", "if(1)", "1 2", "#{a.b.c.d}"):
        with pytest.raises(ValueError):
            expressions.parse(bad)


def test_indicators_over_levels(spark):
    """Two wards in the west and one in the east; beds are averaged over a unit's days, visits are summed."""
    raw = [("V", "20240301", "w1", "day", 6), ("V", "20240331", "w1", "night", 3), ("V", "202403", "w2", "day", 1), ("V", "20240415", "e1", "night", 8), ("V", "20240501", "w1", "day", 70)]
    raw += [("B", p, u, "all", v) for u, a, b in (("w1", 4, 8), ("w2", 12, 6), ("e1", 16, 16)) for p, v in (("20240310", a), ("20240320", b), ("20240410", b))]
    from pyspark.sql import functions as F

    values = spark.createDataFrame(raw, "element string, period string, unit string, option string, value long").withColumns({"attribute": F.lit("x"), "start": periods.period_start(F.col("period")), "end": periods.period_end(F.col("period"))})
    targets = spark.createDataFrame([("202403", 0), ("202404", 1)], "target string, place int").withColumns({"t_start": periods.period_start(F.col("target")), "t_end": periods.period_end(F.col("target"))})
    up = {"w1": "west", "w2": "west", "e1": "east"}
    above = spark.createDataFrame([(u, *x) for u, d in up.items() for x in ((u, 3), (d, 2), ("all", 1))], "unit string, level_unit string, level int")
    levels = facts.by_level(facts.by_unit(facts.to_targets(values, targets), ["B"]), above)
    got = {(r["target"], r["level_unit"]): r["value"] for r in facts.indicator(levels, "#{V}", "#{B}", 30.0).collect()}
    # beds in March: w1 6, w2 9, e1 16; in April 8, 6 and 16
    assert got == {("202403", "w1"): 45, ("202403", "w2"): pytest.approx(10 / 3), ("202403", "west"): 20, ("202403", "all"): pytest.approx(300 / 31), ("202404", "e1"): 15, ("202404", "east"): 15, ("202404", "all"): 8}


def test_minted_hierarchy(spark):
    rows = spark.createDataFrame([("Côte d'Or", "A b", "x"), ("Côte d'Or", "A-b", "y"), ("Côte d'Or", None, "z")], "a string, b string, c string")
    units = bake.mint(rows, ["a", "b"])
    assert {r["id"] for r in units.collect()} == {"cote-d-or", "cote-d-or-a-b"}
    assert [r["id"] for r in bake.collisions(units).collect()] == ["cote-d-or-a-b"]
    from pyspark.sql import functions as F

    from atlasloom.functions.scalars import slugify

    names = {"Ẹdẹ Ọ̀ṣun": "ede-osun", "Şanlıurfa": "sanlurfa", "ﬁne ½ Nº①": "fine-12-no1", "Ｆｕｌｌ　Ｗｉｄｔｈ": "full-width", "O’Neil": "oneil", "東京 City": "city", "Łódź": "odz", "  --  ": "", "İzmir": "izmir", "ǅep": "dzep", "A\\E": "a-e"}
    got = spark.createDataFrame([(x,) for x in names], "x string").select("x", slugify(F.col("x"))).collect()
    assert {r[0]: r[1] for r in got} == names


def test_stream_merges_into_the_snapshot(spark, tmp_path):
    source, folder = tmp_path / "in", f"file://{tmp_path}/snapshot"
    source.mkdir()

    def run():
        lines = spark.readStream.text(str(source)).withColumnRenamed("value", "text")
        incremental.start(lines, folder, f"file://{tmp_path}/checkpoint").awaitTermination(120)
        return {r["id"]: r["text"] for r in incremental.current(spark, folder).collect()}

    (source / "1.txt").write_text('{"id":"a","n":1}\n{"id":"b","n":1}\n{"id":"a","n":2}\n')
    assert run() == {"a": '{"id":"a","n":2}', "b": '{"id":"b","n":1}'}
    (source / "2.txt").write_text('{"id":"b","n":3}\n')
    assert run() == {"a": '{"id":"a","n":2}', "b": '{"id":"b","n":3}'}


def test_resuming_needs_the_same_plan(tmp_path):
    path = str(tmp_path / "c.json")
    incremental.Checkpoint(path, {"units": [1]}).add("1", "out")
    assert incremental.Checkpoint(path, {"units": [1]}).done == {"1": "out"}
    with pytest.raises(ValueError):
        incremental.Checkpoint(path, {"units": [2]})
