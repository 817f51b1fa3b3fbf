"""The statistics server's dataflows against a small server of its own: paging, splitting, both sources of values, comparison and resuming."""

import http.server
import json
import threading
import urllib.parse

import pytest

from atlasloom.functions.naming import DateRange, Instance, age_text, check_reference, clock, fhir_key, size_text, thousands, valid_name
from atlasloom.plans import statistics as flows
from atlasloom.sources import statistics

#: A country of two districts with two clinics each.
UNITS = [("IS", None, 1), ("DA", "IS", 2), ("DB", "IS", 2), ("A1", "DA", 3), ("A2", "DA", 3), ("B1", "DB", 3), ("B2", "DB", 3)]
INDICATORS = [{"id": "COV", "name": "Coverage", "code": "c", "numerator": "#{DOSE}", "denominator": "#{POP}", "indicatorType": {"name": "Per cent", "factor": 100}, "indicatorGroups": [{"id": "g", "name": "Group"}], "lastUpdated": "2024-03-04T05:06:07.000"}]
ELEMENTS = [{"id": "DOSE", "name": "Doses", "aggregationType": "SUM"}, {"id": "POP", "name": "People", "aggregationType": "AVERAGE_SUM_ORG_UNIT"}, {"id": "LAST", "aggregationType": "LAST"}]
VALUES = [("DOSE", "20240305", "A1", "c1", "6"), ("DOSE", "202403", "A2", "c1", "3"), ("DOSE", "20240401", "B1", "c1", "5"), ("DOSE", "2024W18", "B2", "c1", "9"), ("DOSE", "202403", "gone", "c1", "1"), ("DOSE", "202403", "B2", "c1", "many"), ("DOSE", "THEN", "B2", "c1", "1")]
VALUES += [("POP", "202403", u, "c1", str(n)) for u, n in (("A1", 10), ("A2", 20), ("B1", 30), ("B2", 40))] + [("POP", "202404", "B1", "c1", "25")]


@pytest.fixture()
def server():
    state = {"calls": [], "too_large": 3, "analytics": {}}

    class Handler(http.server.BaseHTTPRequestHandler):
        def answer(self, status, body):
            raw = json.dumps(body).encode()
            self.send_response(status)
            self.send_header("Content-Length", str(len(raw)))
            self.end_headers()
            self.wfile.write(raw)

        def paged(self, name, rows, query):
            size, page = int(query.get("pageSize", ["500"])[0]), int(query.get("page", ["1"])[0])
            size = min(size, 3)
            self.answer(200, {"pager": {"pageCount": max(1, -(-len(rows) // size)), "total": len(rows)}, name: rows[(page - 1) * size : page * size]})

        def do_GET(self):
            url = urllib.parse.urlsplit(self.path)
            query, name = urllib.parse.parse_qs(url.query), url.path.removeprefix("/api/").removesuffix(".json")
            state["calls"].append((name, query))
            if self.headers.get("Authorization") != "ApiToken t":
                return self.answer(401, {})
            if name == "system/info":
                return self.answer(200, {"systemName": "Islands", "serverTimeZoneId": "UTC", "lastAnalyticsTableSuccess": "2024-05-01T00:00:00"})
            if name == "organisationUnits":
                rows = [{"id": u, "name": f"Unit {u}", "shortName": u, "level": n, **({"parent": {"id": p}} if p else {}), **shape(u)} for u, p, n in UNITS]
                level = [f.split(":")[2] for f in query.get("filter", []) if f.startswith("level")]
                return self.paged(name, [r for r in rows if not level or str(r["level"]) == level[0]], query)
            if name in ("indicators", "dataElements"):
                rows = INDICATORS if name == "indicators" else ELEMENTS
                wanted = query["filter"][0].split("[")[1][:-1].split(",")
                return self.paged(name, [r for r in rows if r["id"] in wanted or "Groups" in query["filter"][0]], query)
            if name == "analytics":
                dims = dict(d.split(":", 1) for d in query["dimension"] if ":" in d)
                pes = dims["pe"].split(";") if "pe" in dims else ["range"]
                if len(pes) * len(dims["dx"].split(";")) >= state["too_large"]:
                    return self.answer(409, {"errorCode": "E7128"})
                level = int(dims["ou"].split("-")[1].split(";")[0])
                by = [d for d in query["dimension"] if ":" not in d]
                rows = [[d, p, u, str(50.0 + n), "5", "10", *(["opt"] * len(by))] for d in dims["dx"].split(";") for p in pes for n, (u, _, at) in enumerate(UNITS) if at == level]
                return self.answer(200, {"headers": [{"name": x} for x in ["dx", "pe", "ou", "value", "numerator", "denominator", *by]], "rows": rows, "metaData": {"items": {"opt": {"name": "Option"}, "cat": {"name": "Category"}}}})
            if name == "dataValueSets":
                since = "lastUpdated" in query
                rows = [v for v in VALUES if v[0] in query["dataElement"] and (not since or v[1] == "20240401")]
                return self.answer(200, {"dataValues": [dict(zip(("dataElement", "period", "orgUnit", "categoryOptionCombo", "value"), v, strict=True)) for v in rows]})
            return self.answer(404, {})

        def log_message(self, *args):
            pass

    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}", state
    s.shutdown()


def shape(unit):
    box = {"DA": 0, "DB": 4}
    if unit in box:
        x = box[unit]
        return {"geometry": {"type": "Polygon", "coordinates": [[[x, 0], [x + 4, 0], [x + 4, 3], [x, 3], [x, 0]]]}}
    return {"geometry": {"type": "Point", "coordinates": [1, 2] if unit != "B2" else [400, 2]}} if unit[1].isdigit() else {}


def lines(path):
    return [json.loads(x) for x in open(path)]


def test_units_become_places(spark, server, tmp_path):
    url, _ = server
    report = flows.units(spark, url, "is", str(tmp_path / "u.ndjson"), token="t")
    docs = lines(tmp_path / "u.ndjson")
    assert [d["id"] for d in docs] == ["is-IS", "is-DA", "is-DB", *(x for u in ("A1", "A2", "B1", "B2") for x in (f"org-is-{u}", f"is-{u}"))]
    assert report["counts"] == {"boundary_from_children": 1, "bad_geometry": 1} and report["levels"] == {1: (1, "admin units"), 2: (2, "admin units"), 3: (4, "facilities")}
    assert docs[0]["extension"][0]["valueAttachment"]["contentType"] == "application/geo+json" and docs[4]["partOf"] == {"reference": "Location/is-DA"} and "position" in docs[4]
    with pytest.raises(ValueError, match="prefix"):
        flows.units(spark, url, "is", "x", prefix="a b", token="t")


def test_measures_hold_their_items(spark, server, tmp_path):
    url, _ = server
    found = flows.measures(spark, url + "/api/", "is", str(tmp_path / "m.ndjson"), indicators=["COV"], data_elements=["DOSE"], token="t")
    cov, dose = lines(tmp_path / "m.ndjson")
    assert found == {"written": 2, "scoring": {"proportion": 1, "data element counts": 1}}
    assert cov["id"] == "is-COV" and cov["date"] == "2024-03-04T05:06:07.000Z" and cov["publisher"] == "Islands" and cov["topic"][0]["coding"][0]["code"] == "g" and len(cov["identifier"]) == 2
    assert [e["url"] for e in cov["extension"][0]["extension"]] == ["factor", "indicatorType", "annualized"] and [p["criteria"]["expression"] for p in dose["group"][0]["population"]] == ["#{DOSE}"]
    with pytest.raises(ValueError, match="no indicators: NONE"):
        flows.measures(spark, url, "is", "x", indicators=["NONE"], token="t")


@pytest.fixture()
def locations(tmp_path):
    own = Instance("is")
    path = tmp_path / "locations.ndjson"
    path.write_text("".join(json.dumps({"resourceType": "Location", "id": f"p{u}", "name": u, "identifier": [{"system": own.identifier("orgunit"), "value": u}], **({"partOf": {"reference": f"Location/p{p}"}} if p else {})}) + "\n" for u, p, _ in UNITS if u != "B1"))
    return str(path)


def test_reports_from_analytics(spark, server, locations, tmp_path):
    url, state = server
    out = str(tmp_path / "r.ndjson")
    args = {"levels": [2, 3], "periods_": ["202401", "202402", "202403", "202404"], "ranges": ["2024-01-01:2024-01-20"], "indicators": ["COV"], "breakdowns": ["cat"], "campaign": "CarePlan/x", "checkpoint": str(tmp_path / "kept"), "token": "t", "retries": 0}
    report = flows.reports(spark, url, "is", locations, out, **args)
    docs = lines(out)
    assert report["lines"] == len(docs) == 25 and report["counts"] == {"unmapped_org_unit": 1} and (report["locations"], report["periods"]) == (5, 5)
    assert [d["id"] for d in docs[:2]] == ["is-COV-DA-202401", "is-COV-DA-202402"] and docs[0]["group"][0]["population"][0]["count"] == 5 and docs[0]["subject"] == {"reference": "Location/pDA", "display": "DA"}
    assert docs[0]["group"][0]["stratifier"][0]["stratum"][0]["value"]["text"] == "Option" and [e.get("valueCode") for e in docs[0]["extension"]] == [None, None, "analytics"]
    spans = [d for d in docs if d["extension"][0]["valueString"] == "2024-01-01/2024-01-20"]
    assert len(spans) == 5 and spans[0]["period"] == {"start": "2024-01-01", "end": "2024-01-20"} and spans[0]["id"] == "is-COV-DA-20240101-20240120"
    asked = len([c for c, _ in state["calls"] if c == "analytics"])
    assert asked > report["requests"]  # too large results were asked for in halves
    again = flows.reports(spark, url, "is", locations, str(tmp_path / "again.ndjson"), previous=out, **args)
    assert len([c for c, _ in state["calls"] if c == "analytics"]) == asked and lines(tmp_path / "again.ndjson") == docs and again["unchanged"] == 25
    with pytest.raises(ValueError, match="another plan"):
        flows.reports(spark, url, "is", locations, out, **(args | {"levels": [3]}))


def test_reports_from_data_values(spark, server, locations, tmp_path):
    url, _ = server
    out, args = str(tmp_path / "v.ndjson"), {"levels": [1, 2, 3], "periods_": ["202403", "202404"], "indicators": ["COV"], "source": "data-values", "token": "t"}
    report = flows.reports(spark, url, "is", locations, out, **args)
    got = {d["id"]: d["group"][0]["measureScore"]["value"] for d in lines(out)}
    # March: 6 of 10 and 3 of 20, both of 30; the country has 9 of 70 (B1 has no place)
    assert got == {"is-COV-A1-202403": 0.6, "is-COV-A2-202403": 0.15, "is-COV-DA-202403": 0.3, "is-COV-IS-202403": pytest.approx(9 / 70)}
    assert report["counts"] == {"unsupported_period": 1, "straddling_period": 1, "unmapped_org_unit": 2, "non_numeric_value": 1}
    before = tmp_path / "before.ndjson"
    docs = lines(out)
    docs[0]["group"][0]["measureScore"]["value"] = 1
    gone = json.loads(json.dumps(docs[1]).replace("is-COV-A2-202403", "is-COV-A2x-202403"))
    other = json.loads(json.dumps(docs[1]).replace("is-COV-A2-202403", "is-COV-A2-201901").replace('"202403"', '"201901"'))
    before.write_text("".join(json.dumps(d) + "\n" for d in [docs[0], docs[2], docs[3], gone, other]))
    compared = flows.reports(spark, url, "is", locations, str(tmp_path / "n.ndjson"), previous=str(before), removed=str(tmp_path / "gone"), changed=str(tmp_path / "changed.ndjson"), **args)
    assert (compared["new"], compared["changed"], compared["unchanged"]) == (1, 1, 2)
    assert open(tmp_path / "gone").read() == "is-COV-A2x-202403\n" and {d["id"] for d in lines(tmp_path / "changed.ndjson")} == {docs[0]["id"], docs[1]["id"]}
    since = flows.reports(spark, url, "is", locations, str(tmp_path / "s.ndjson"), updated_since="1d", previous=str(before), **args)
    assert since["written"] == 0 and {d["id"] for d in lines(tmp_path / "s.ndjson")} == {d["id"] for d in [docs[0], docs[2], docs[3], gone, other]}
    with pytest.raises(ValueError, match="LAST"):
        flows.reports(spark, url, "is", locations, out, **(args | {"indicators": None, "data_elements": ["LAST"]}))


def test_names_and_texts():
    assert statistics.api_base("https://x.org/d/api/") == statistics.api_base("https://x.org/d") == "https://x.org/d/api"
    assert DateRange.parse("2024-04-05:2024-05-20").code == "20240405-20240520" and DateRange.of_code("20240405-20240520").label == "2024-04-05/2024-05-20" and DateRange.of_code("202404") is None
    for bad in ("2024-04-05", "2024-05-20:2024-04-05", "2024-02-30:2024-03-01", "20240405:20240520"):
        with pytest.raises(ValueError):
            DateRange.parse(bad)
    for bad in ("", "a b", "x" * 17):
        with pytest.raises(ValueError):
            Instance(bad)
    assert fhir_key("a_b") == "a-b" and valid_name("A-1", 3) and not valid_name("A-12", 3) and check_reference("CarePlan/a.b") and age_text(3600 * 47) == "47 hours" and age_text(3600 * 49) == "2 days"
    assert (size_text(1023), size_text(1536), thousands(1234567), clock(3725)) == ("1023 B", "1.5 KB", "1,234,567", "1:02:05")
    with pytest.raises(ValueError):
        check_reference("careplan/a")


def test_rasters_are_fetched_once(server, tmp_path):
    from atlasloom.sources.rest import Cache

    class Client:
        calls = 0

        def call(self, url):
            self.calls += 1
            return b"II*\0data" if "good" in url else b"<html>"

    client, cache = Client(), Cache(str(tmp_path))
    path = statistics.raster_file("http://x/good.tif", cache, client)
    assert statistics.raster_file("http://x/good.tif", cache, client) == path and client.calls == 1 and open(path, "rb").read() == b"II*\0data"
    assert statistics.raster_file("/local.tif", cache, client) == "/local.tif"
    with pytest.raises(ValueError, match="TIFF"):
        statistics.raster_file("http://x/bad.tif", cache, client)
    assert cache.get("http://x/bad.tif") is None
