"""Registries made from files, the entry without its optional part, and the command line's flags."""

import base64
import builtins
import importlib
import json
import sys

import pytest

from atlasloom import cli
from atlasloom.functions import geometry as geo
from atlasloom.functions import patches
from atlasloom.operators import imports
from atlasloom.plans import imports as flows

from .registry import square


def feature(state, ward, code, shape, **more):
    return {"type": "Feature", "properties": {"state": state, "ward": ward, "code": code, **more}, "geometry": shape}


def write(path, features, **more):
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features, **more}))
    return str(path)


def test_units_are_baked(spark, tmp_path):
    features = [feature("Ẹdo", "Oak Hill", "W1", square(0, 0, 2, 2), also="Oak; Hill ;"), feature("Ẹdo", "Elm", None, square(2, 0, 4, 2)), feature("Kogi", "Elm", "W3", None), feature("Kogi", " ", "W4", square(9, 9, 10, 10))]
    out = tmp_path / "u.ndjson"
    given = write(tmp_path / "w.geojson", features, crs={"type": "name", "properties": {"name": "EPSG:4326"}})
    report = flows.bake(spark, given, "Land=LA", ["state=state", "ward=ward:code"], str(out), alias=["ward=also"], dissolve=True)
    docs = [json.loads(x) for x in open(out)]
    assert [d["id"] for d in docs] == ["la", "la-edo", "la-kogi", "la-edo-w1", "la-edo-elm", "la-kogi-w3"]
    assert report["counts"] == {"missing_field": 1, "geometry_invalid": 1} and docs[3]["alias"] == ["Oak", "Hill"] and docs[3]["partOf"] == {"reference": "Location/la-edo"}
    assert [d["identifier"][0]["value"] for d in docs] == ["LA", "la-edo", "la-kogi", "W1", "la-edo-elm", "W3"]
    area = {d["id"]: sum(geo.signed_area(r) for p in geo.parse_boundary(base64.b64decode(d["extension"][0]["valueAttachment"]["data"]))[0][1] for r in p) for d in docs if "extension" in d}
    assert area == {"la": 8, "la-edo": 8, "la-edo-w1": 4, "la-edo-elm": 4}
    for bad, match in (([features[0], features[0]], "more than once"), ([features[0], feature("Edo", "Ash", "W9", None)], "several names"), ([feature("Edo", None, None, None)], "empty everywhere")):
        with pytest.raises(ValueError, match=match):
            flows.bake(spark, write(tmp_path / "b.geojson", bad), "Land=LA", ["state=state", "ward=ward:code"], str(out))
    with pytest.raises(ValueError, match="longitude"):
        flows.bake(spark, write(tmp_path / "c.geojson", features, crs={"type": "name", "properties": {"name": "EPSG:3857"}}), "Land=LA", ["state=state"], str(out))
    imports.check_crs({})


def test_points_are_placed(spark, tmp_path):
    admins = [{"id": "la", "name": "Land"}, {"id": "edo", "name": "Edo", "partOf": {"reference": "Location/la"}}, {"id": "oak", "name": "Oak Hill", "alias": ["Oak"], "partOf": {"reference": "Location/edo"}}]
    (tmp_path / "a.ndjson").write_text("".join(json.dumps(a) + "\n" for a in admins))
    (tmp_path / "p.csv").write_text("id,name,lat,lon,state,ward,code,tier\nf1,One,1.5,2.5,EDO,oak!,C1,Tier One\nf2,Two,north,1,Edo,Ash,,\nf3,Three,91,1,Nowhere,,,\nf 4,Four,1,1,Edo,,,\nf5,,1,1,Edo,,,\nf6,Six,1,1,Skip,,,\n")
    out, args = tmp_path / "s.ndjson", {"parent": ["state", "ward"], "identifier": ["urn:code=code"], "types": ["urn:tier=tier"], "cells": ["geohash:4"], "paired": True}
    report = flows.bake_points(spark, str(tmp_path / "p.csv"), str(tmp_path / "a.ndjson"), "facility", str(out), **args)
    docs = {d["id"]: d for d in map(json.loads, open(out))}
    assert list(docs) == [x for k in (1, 2, 3, 6) for x in (f"org-f{k}", f"f{k}")]
    one = docs["f1"]
    assert one["partOf"] == {"reference": "Location/oak"} and one["position"] == {"longitude": 2.5, "latitude": 1.5} and one["identifier"] == [{"system": "urn:code", "value": "C1"}] and one["managingOrganization"] == {"reference": "Organization/org-f1"}
    assert one["type"][1]["coding"][0] == {"system": "urn:tier", "code": "tier-one", "display": "Tier One"} and one["extension"][0]["extension"][2]["valueString"] == patches.geohash(2.5, 1.5, 4) and docs["org-f1"]["type"][0]["coding"][0]["code"] == "prov"
    assert docs["f2"]["partOf"] == {"reference": "Location/edo"} and "position" not in docs["f2"] and "extension" not in docs["f2"]
    assert report["counts"] == {"missing_field": 1, "invalid_id": 1, "missing_position": 2, "parent_unresolved": 3}
    only = flows.bake_points(spark, str(tmp_path / "p.csv"), str(tmp_path / "a.ndjson"), "facility", str(out), where=["state=EDO"])
    assert only["written"] == 1
    (tmp_path / "d.csv").write_text("id,name,lat,lon\nx,A,1,1\nx,B,1,1\n")
    with pytest.raises(ValueError, match="more than once"):
        flows.bake_points(spark, str(tmp_path / "d.csv"), str(tmp_path / "a.ndjson"), "facility", str(out))


def test_the_entry_does_without_its_optional_part(monkeypatch):
    for missing in ("atlasloom.llm", "corpus_pipeline", "public_tokenizers"):
        for name in [n for n in sys.modules if n.startswith(("atlasloom.llm", "corpus_pipeline", "__spark_entry__"))]:
            monkeypatch.delitem(sys.modules, name)
        real = builtins.__import__

        def without(name, *args, missing=missing, real=real, **kwargs):
            if name == missing or name.startswith(missing + ".") or (name == "atlasloom" and missing == "atlasloom.llm" and "llm" in (args[2] or ())):
                raise ImportError(f"No module named {missing}")
            return real(name, *args, **kwargs)

        monkeypatch.setattr(builtins, "__import__", without)
        entry = importlib.import_module("__spark_entry__")
        monkeypatch.setattr(builtins, "__import__", real)
        names = entry.queries()
        assert len(names) > 100 and all(n.startswith("q_") for n in names) and set(entry.oracle_sql()) == set(names)
        monkeypatch.delitem(sys.modules, "__spark_entry__")


def test_flags_of_all_commands():
    own = cli.parser()
    args = own.parse_args(["reports", "--server", "s", "--instance", "i", "--locations", "l", "--out", "o", "--levels", "2", "--levels", "3", "--periods", "202401", "--indicators", "a", "--updated-since", "1d"])
    assert (args.levels, args.periods_, args.indicators, args.updated_since) == ([2, 3], ["202401"], ["a"], "1d")
    assert len(cli.COMMANDS) == 14 and own.parse_args(["bake", "--given", "g", "--country", "L=LA", "--levels", "a=b", "--out", "o"]).levels == ["a=b"]
