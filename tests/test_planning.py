"""Request units within a bound, and memberships without repeats."""

from atlasloom.operators import planning


def test_units_keep_within_the_bound(spark):
    indicators = spark.createDataFrame([(f"i{k}", k) for k in range(5)], "id string, place int")
    names = ["202501", "202502", "LAST_12_MONTHS", "2025Q1", "202503", "202504"]
    periods = spark.createDataFrame([(p, k) for k, p in enumerate(names)], "period string, place int")
    got = planning.number_units(planning.request_units(indicators, periods, [(2, 4), (3, 1000)], 2, 16)).orderBy("unit").collect()
    assert [(r["level"], r["indicators"], r["periods"]) for r in got if r["level"] == 2] == [
        *[(2, [f"i{c}", f"i{c + 1}"], p) for c in (0, 2) for p in (["202501", "202502"], ["202503", "202504"], ["LAST_12_MONTHS"], ["2025Q1"])],
        *[(2, ["i4"], p) for p in (["202501", "202502", "202503", "202504"], ["LAST_12_MONTHS"], ["2025Q1"])],
    ]
    assert all(len(r["periods"]) == 1 for r in got if r["level"] == 3) and len([r for r in got if r["level"] == 3]) == 18


def test_memberships(spark):
    groups = spark.createDataFrame([("g1", "One", 0, ["a", "b"]), ("g2", "Two", 1, ["a"])], "id string, name string, place int, units array<string>")
    sets = spark.createDataFrame([("g2", "Two", 0, ["a"])], "id string, name string, place int, units array<string>")
    got = {r["unit"]: [g["id"] for g in r["groups"]] for r in planning.memberships(groups, sets).collect()}
    assert got == {"a": ["g2", "g1"], "b": ["g1"]}
