"""The statistics server's dataflows: its units as places, its items as measures, its values as reports."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expressions, periods
from ..functions.documents import Profile, content_hash
from ..functions.naming import MOST_PREFIX, DateRange, Instance, check_reference, valid_name
from ..operators import builders, facts, imports, mapping, merge, planning
from ..operators.order import write_text
from ..sources import files, statistics
from ..streaming.incremental import Checkpoint
from ..workspace import folder, written
from . import dataflows

_UNIT = "struct<id:string,name:string,shortName:string,code:string,level:int,parent:struct<id:string>,closedDate:string>"
_FIELDS = {
    "indicators": "id,name,code,description,numerator,numeratorDescription,denominator,denominatorDescription,annualized,decimals,indicatorType[name,factor],indicatorGroups[id,name],lastUpdated",
    "dataElements": "id,name,code,description,aggregationType,dataElementGroups[id,name,groupSets[id]],lastUpdated",
    "dataSets": "id,name,code,description,periodType,lastUpdated",
}


class Server:
    """A server's address and credentials, and its lists as tables."""

    def __init__(self, spark: SparkSession, server: str, **credentials: str | None):
        statistics.register(spark)
        self.spark, self.options = spark, {"server": server} | {k: str(v) for k, v in credentials.items() if v is not None}
        self.client = statistics.client_of(self.options)
        self.info = self.client.get("system/info.json")

    def table(self, name: str, **query: str | list[str]) -> DataFrame:
        parts = [(k, x) for k, v in query.items() for x in (v if isinstance(v, list) else [v])]
        return written(self.spark.read.format("unit_list").options(**self.options, list=name, query=json.dumps(parts)).load(), f"{folder(self.spark)}/{name}")

    @property
    def utc(self) -> bool:
        return self.info.get("serverTimeZoneId") in ("UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z")


def units(spark: SparkSession, server: str, instance: str, out: str, facility_level: int | None = None, prefix: str | None = None, root: str | None = None, **credentials: str) -> dict:
    """Every unit as a place, and an organization before each facility; admin units without a boundary get their children's union."""
    own, prefix = Instance(instance), prefix or instance
    if not valid_name(prefix, MOST_PREFIX):
        raise ValueError(f"a prefix is at most {MOST_PREFIX} letters, digits and hyphens: {prefix}")
    api = Server(spark, server, **credentials)
    lines = api.table("organisationUnits", fields="id,name,shortName,code,level,parent[id],closedDate,geometry", **({"filter": f"path:like:{root}"} if root else {}))
    rows = lines.select(F.struct("page", "nth").alias("seq"), F.from_json("text", _UNIT).alias("u"), F.get_json_object("text", "$.geometry").alias("geometry")).select("seq", "u.*", "geometry").withColumn("parent", F.col("parent.id"))
    rows = written(rows, f"{folder(spark)}/units")
    most = rows.agg(F.max("level")).first()[0]
    if most is None:
        raise ValueError("the server has no units for this selection")
    level = facility_level or most
    point = F.get_json_object("geometry", "$.type") == "Point"
    at = F.from_json(F.get_json_object("geometry", "$.coordinates"), "array<double>")
    good = point & F.get(at, F.lit(0)).between(-180, 180) & F.get(at, F.lit(1)).between(-90, 90)
    shapes = imports.shapes(rows.where(~F.coalesce(point, F.lit(True))).select("seq", "geometry")).select(F.col("seq").alias("_s"), "wkb", "issue")
    shaped = written(rows.join(shapes, F.col("seq") == F.col("_s"), "left"), f"{folder(spark)}/shaped")
    filled, issues = mapping.missing_boundaries(shaped.select("id", "parent", "level", F.col("wkb").alias("geometry")), level)
    bad = shaped.where((point & ~F.coalesce(good, F.lit(False))) | (F.col("issue").isNotNull() & F.col("wkb").isNull())).select(F.lit("bad_geometry").alias("kind"), F.col("id").alias("location_id"), F.coalesce("issue", F.lit("no usable coordinates")).alias("detail"))
    known = shaped.select(F.col("id").alias("_p"))
    lost = shaped.where("parent is not null and level > 1").join(known, F.col("parent") == F.col("_p"), "left_anti").select(F.lit("parent_not_exported").alias("kind"), F.col("id").alias("location_id"), F.col("parent").alias("detail"))
    below = shaped.where(F.col("level") > level).select(F.lit("below_facility_level").alias("kind"), F.col("id").alias("location_id"), F.col("level").cast("string").alias("detail"))
    placed = shaped.where(F.col("level") <= level).join(known, F.col("parent") == F.col("_p"), "left")
    placed = placed.withColumns({"longitude": F.when(good, F.get(at, F.lit(0))), "latitude": F.when(good, F.get(at, F.lit(1)))}).withColumn("parent", F.col("_p")).select("id", "name", "shortName", "level", "parent", "closedDate", "longitude", "latitude")
    docs = builders.unit_places(placed, level, f"{prefix}-", Profile(identifiers={"unit-uid": own.identifier("orgunit")}))
    docs = imports._attached(docs.join(filled.select(F.concat(F.lit(f"{prefix}-"), "id").alias("_i"), "geometry"), (F.col("id") == F.col("_i")) & (F.col("place") == 1), "left").drop("_i"), Profile())
    boundary = F.concat(F.lit('{"extension":[{"url":"' + Profile().boundaries[0] + '","valueAttachment":{"contentType":"application/geo+json","data":"'), "boundary", F.lit('"}}],'))
    text = F.when(F.col("boundary").isNotNull(), F.concat(boundary, F.substring("json", 2, 1 << 30))).otherwise(F.col("json"))
    docs = written(docs.select("level", "unit", "place", text.alias("text")), f"{folder(spark)}/docs")
    n = write_text(docs, out, ["level", "unit", "place"])
    counts = {r["level"]: (r["n"], r["role"]) for r in mapping.level_counts(shaped, level).collect()}
    return dataflows.report_of(issues.unionByName(bad).unionByName(lost).unionByName(below), written=n, levels=counts)


def items(api: Server, indicators: list[str] | None = None, data_elements: list[str] | None = None, data_sets: list[str] | None = None, indicator_groups: list[str] | None = None, data_element_groups: list[str] | None = None) -> DataFrame:
    """The selected items (builders.ITEM); what the server does not have is an error."""
    wanted = [("indicators", "id", indicators), ("indicators", "indicatorGroups.id", indicator_groups), ("dataElements", "id", data_elements), ("dataElements", "dataElementGroups.id", data_element_groups), ("dataSets", "id", data_sets)]
    if not any(ids for _, _, ids in wanted):
        raise ValueError("no items are selected")
    found = None
    text, none = F.col("text"), F.lit(None)

    def get(path: str):
        return F.get_json_object(text, f"$.{path}")

    groups = "array<struct<id:string,name:string,groupSets:array<struct<id:string>>>>"

    def grouped(path: str):
        held = F.coalesce(F.from_json(get(path), groups), F.array().cast(groups))
        return F.transform(held, lambda g: F.struct(g["id"].alias("id"), g["name"].alias("name"), F.coalesce(F.transform(g["groupSets"], lambda s: s["id"]), F.array().cast("array<string>")).alias("sets")))

    for kind, field, ids in wanted:
        if not ids:
            continue
        rows = api.table(kind, fields=_FIELDS[kind], filter=[f"{field}:in:[{','.join(ids)}]"] + ["domainType:eq:AGGREGATE"] * (field == "dataElementGroups.id"))
        uid, name = get("id"), F.coalesce(get("name"), get("id"))
        if kind == "indicators":
            factor = F.coalesce(F.nullif(get("indicatorType.factor").try_cast("double"), F.lit(0.0)), F.lit(1.0))
            shape = [uid, uid, F.lit("indicator"), name, get("code"), get("description"), F.coalesce(get("numerator"), F.lit("")), get("numeratorDescription"), F.coalesce(get("denominator"), F.lit("1")), get("denominatorDescription"), factor, get("indicatorType.name"), F.coalesce(get("annualized").try_cast("boolean"), F.lit(False)), get("decimals").try_cast("int"), grouped("indicatorGroups"), get("lastUpdated")]
        elif kind == "dataElements":
            shape = [uid, uid, F.lit("data element"), name, get("code"), get("description"), F.concat(F.lit("#{"), uid, F.lit("}")), none, F.lit("1"), none, F.lit(1.0), F.concat(F.lit("Data element"), F.coalesce(F.concat(F.lit(" ("), get("aggregationType"), F.lit(")")), F.lit(""))), F.lit(False), none, grouped("dataElementGroups"), get("lastUpdated")]
        else:
            rate = F.concat(uid, F.lit(".REPORTING_RATE"))
            shape = [rate, uid, F.lit("reporting rate"), F.concat(name, F.lit(" - Reporting rate")), get("code"), get("description"), F.concat(F.lit("R{"), uid, F.lit(".ACTUAL_REPORTS}")), F.lit("Actual reports"), F.concat(F.lit("R{"), uid, F.lit(".EXPECTED_REPORTS}")), F.lit("Expected reports"), F.lit(100.0), F.concat(F.lit("Reporting rate"), F.coalesce(F.concat(F.lit(" ("), get("periodType"), F.lit(")")), F.lit(""))), F.lit(False), none, F.array(), get("lastUpdated")]
        named = [f.strip().rsplit(" ", 1) if "<" not in f else f.strip().split(" ", 1) for f in builders.ITEM.split(", ")]
        rows = rows.select(*[c.cast(t).alias(n) for c, (n, t) in zip(shape, named, strict=True)])
        if field == "id":
            missing = sorted(set(ids) - {r["uid"] for r in rows.select("uid").collect()})
            if missing:
                raise ValueError(f"the server has no {kind}: {', '.join(missing)}")
        found = rows if found is None else found.unionByName(rows)
    return written(found.dropDuplicates(["id"]), f"{folder(api.spark)}/items")


def measures(spark: SparkSession, server: str, instance: str, out: str, indicators: list[str] | None = None, data_elements: list[str] | None = None, data_sets: list[str] | None = None, indicator_groups: list[str] | None = None, data_element_groups: list[str] | None = None, **credentials: str) -> dict:
    api = Server(spark, server, **credentials)
    selected = items(api, indicators, data_elements, data_sets, indicator_groups, data_element_groups)
    docs = written(builders.measure_documents(selected, Instance(instance), api.info.get("systemName"), api.utc), f"{folder(spark)}/measures")
    n = write_text(docs, out, ["id"], "json")
    return {"written": n, "scoring": {r["scoring"]: r["n"] for r in mapping.scoring_counts(docs).collect()}}


def _targets(spark: SparkSession, codes: list[str], ranges: list[DateRange]) -> DataFrame:
    rows = [(c, k, None, None) for k, c in enumerate(codes)] + [(r.code, len(codes) + k, r.start, r.end) for k, r in enumerate(ranges)]
    found = spark.createDataFrame(rows, "target string, place int, a string, b string")
    return found.select("target", "place", F.coalesce(F.col("a").cast("date"), periods.period_start(F.col("target"))).alias("t_start"), F.coalesce(F.col("b").cast("date"), periods.period_end(F.col("target"))).alias("t_end"))


def reports(spark: SparkSession, server: str, instance: str, locations: str, out: str, levels: list[int], periods_: list[str] | None = None, ranges: list[str] | None = None, source: str = "analytics", indicators: list[str] | None = None, data_elements: list[str] | None = None, data_sets: list[str] | None = None, breakdowns: list[str] | None = None, root: str | None = None, campaign: str | None = None,
            chunk: int = 10, max_rows: int = 20_000, updated_since: str | None = None, previous: str | None = None, changed: str | None = None, removed: str | None = None, checkpoint: str | None = None, **credentials: str) -> dict:
    """Values as reports, from the server's own analytics or computed from its data values; compared with an earlier run's reports.

    Requests run on the executors, one task a planned unit; reports are written in the order of units and ids, whatever ran first.
    With a checkpoint a unit's answers are kept below it and a later run of the same plan asks for the others alone.
    """
    own, codes, spans = Instance(instance), list(periods_ or []), [DateRange.parse(r) for r in ranges or []]
    if not codes and not spans:
        raise ValueError("no periods and no ranges are asked for")
    if campaign:
        check_reference(campaign)
    api = Server(spark, server, **credentials)
    selected = items(api, indicators, data_elements, data_sets)
    lines = files.read_lines(spark, locations)
    places = written(mapping.unit_mapping(lines, own.identifier("orgunit")), f"{folder(spark)}/mapping")
    targets = written(_targets(spark, codes, spans), f"{folder(spark)}/targets")
    scoring = F.when(F.trim("denominator") == "1", "cohort").when(F.col("factor") == 100, "proportion").otherwise("ratio")
    kinds = selected.select(F.col("id").alias("_id"), scoring.alias("scoring"), "factor")
    if source == "analytics":
        values, strata, asked = _from_analytics(api, selected, codes, spans, levels, root, breakdowns or [], chunk, max_rows, checkpoint)
        issues = None
    elif source == "data-values":
        values, issues, asked = _from_values(api, selected, targets, lines, own, levels, root, updated_since)
        strata = None
    else:
        raise ValueError(f"values come from analytics or data-values: {source}")
    met, more = mapping.matched(values, selected.select("id"), places)
    if strata is not None:
        strata = mapping.matched(strata, selected.select("id"), places)[0].drop("location", "location_name")
    met = met.join(kinds, F.col("dx") == F.col("_id")).drop("_id").join(targets.select(F.col("target").alias("_t"), F.col("t_start").alias("start"), F.col("t_end").alias("end")), F.col("pe") == F.col("_t"), "left")
    undated = met.where("start is null").select("pe").distinct().select(F.lit("period_without_dates").alias("kind"), F.col("pe").alias("location_id"), F.lit("no first and last day").alias("detail"))
    date = api.info.get("lastAnalyticsTableSuccess")
    docs, figures = builders.report_documents(met.where("start is not null"), own, strata, source, campaign, (date or "")[:10] or None, api.info.get("systemName"))
    docs = written(docs, f"{folder(spark)}/reports")
    issues = figures.unionByName(more).unionByName(undated) if issues is None else figures.unionByName(more).unionByName(undated).unionByName(issues)
    result = {"requests": asked}
    if previous:
        docs, gone = _compared(spark, docs, previous, selected, own, updated_since is not None)
        if removed:
            result["removed"] = write_text(written(gone, f"{folder(spark)}/gone"), removed, ["id"], "id")
        if changed:
            result["changed_written"] = write_text(docs.where("change in ('new', 'changed')"), changed, ["unit", "id"], "json")
    else:
        docs = docs.withColumn("change", F.lit(None).cast("string"))
    n = write_text(docs, out, ["unit", "id"], "json")
    tally = mapping.run_tallies(docs.where("change is null or change <> 'kept'")).first().asDict()
    return dataflows.report_of(issues, **result, lines=n, **tally)


def _from_analytics(api: Server, selected: DataFrame, codes: list[str], spans: list[DateRange], levels: list[int], root: str | None, breakdowns: list[str], chunk: int, max_rows: int, checkpoint: str | None) -> tuple[DataFrame, DataFrame | None, int]:
    spark, under = api.spark, {"filter": f"path:like:{root}"} if root else {}
    counted = []
    for level in levels:  # the levels that a run names
        parts = [("filter", f"level:eq:{level}"), *under.items(), ("fields", "id"), ("pageSize", "1")]
        counted.append((level, api.client.get("organisationUnits.json" + statistics.query(parts))["pager"]["total"]))
    from pyspark.sql import Window

    ids = selected.select("id", (F.row_number().over(Window.orderBy("id")) - 1).alias("place"))  # the items that a run names
    plan: list[dict] = []
    if codes:
        asked = spark.createDataFrame([(c, k) for k, c in enumerate(codes)], "period string, place int")
        for r in planning.number_units(planning.request_units(ids, asked, counted, chunk, max_rows)).orderBy("unit").collect():
            plan.append({"level": r["level"], "indicators": list(r["indicators"]), "periods": list(r["periods"]), "root": root})
    names = [r["id"] for r in ids.orderBy("place").collect()]
    plan += [{"level": level, "indicators": names[k : k + chunk], "range": [s.start, s.end], "root": root} for level, _ in counted for k in range(0, len(names), chunk) for s in spans]
    whole = [{**p, "breakdown": b} for p in plan for b in [None, *breakdowns]]
    answers = _answers(api, whole, checkpoint)
    code = {k: DateRange(*p["range"]).code for k, p in enumerate(whole) if p.get("range")}
    rows = files.read_analytics(answers, ["unit"])
    if code:
        at = F.create_map(*[F.lit(x) for k, c in code.items() for x in (k, c)])
        rows = rows.withColumn("pe", F.coalesce(F.try_element_at(at, F.col("unit")), F.col("pe")))
    per = 1 + len(breakdowns)
    rows = rows.withColumns({"_which": F.col("unit") % per, "unit": F.floor(F.col("unit") / per).cast("int")})
    totals = rows.where("_which = 0").drop("option", "_which")
    if not breakdowns:
        return totals, None, len(whole)
    named = answers.select((F.col("unit") % per).alias("_w"), F.explode(F.from_json(F.get_json_object("text", "$.metaData.items"), "map<string,struct<name:string>>")).alias("_k", "_v")).select("_w", "_k", F.col("_v.name").alias("_n")).where("_w > 0").distinct()
    which = F.element_at(F.array(*map(F.lit, breakdowns)), F.col("_which").cast("int"))
    strata = rows.where("_which > 0").withColumn("breakdown", which)
    strata = strata.join(named.select(F.col("_w").alias("_which"), F.col("_k").alias("option"), F.col("_n").alias("_o")), ["_which", "option"], "left").join(named.select(F.col("_w").alias("_which"), F.col("_k").alias("breakdown"), F.col("_n").alias("_b")), ["_which", "breakdown"], "left")
    return totals, strata.select("dx", "ou", "pe", "breakdown", F.coalesce("_b", "breakdown").alias("breakdown_name"), "option", F.coalesce("_o", "option").alias("option_name"), "value", "numerator", "denominator"), len(whole)


def _answers(api: Server, plan: list[dict], checkpoint: str | None) -> DataFrame:
    """(unit, nth, text) of all planned requests; with a checkpoint, of the units that it does not hold yet, and the others from there."""

    def read(units: list[dict]) -> DataFrame:
        return api.spark.read.format("unit_analytics").options(**api.options, units=json.dumps(units)).load()

    if checkpoint is None:
        return written(read(plan), f"{folder(api.spark)}/answers")
    os.makedirs(checkpoint, exist_ok=True)
    state = Checkpoint(f"{checkpoint}/state.json", {"units": plan, "server": api.options["server"]})
    step = api.spark.sparkContext.defaultParallelism * 2
    for low in range(0, len(plan), step):  # a wave of units is one job, and kept when it is done
        if str(low) not in state.done:
            read(plan[low : low + step]).withColumn("unit", F.col("unit") + low).write.mode("overwrite").parquet(f"{checkpoint}/units-{low}")
            state.add(str(low), f"units-{low}")
    return api.spark.read.schema("unit int, nth int, text string").parquet(*[f"{checkpoint}/{x}" for x in state.done.values()])


def _from_values(api: Server, selected: DataFrame, targets: DataFrame, lines: DataFrame, own: Instance, levels: list[int], root: str | None, since: str | None) -> tuple[DataFrame, DataFrame, int]:
    spark = api.spark
    rows = [r.asDict() for r in selected.orderBy("id").collect()]  # the items that a run names
    bad = [r["id"] for r in rows if r["kind"] == "reporting rate"]
    if bad:
        raise ValueError(f"reporting rates have no data values: {', '.join(bad)}")
    needed = {r["id"]: expressions.items(expressions.parse(r["numerator"])) + expressions.items(expressions.parse(r["denominator"])) for r in rows}
    elements = sorted({i.element for found in needed.values() for i in found})
    held = api.table("dataElements", fields="id,aggregationType", filter=f"id:in:[{','.join(elements)}]").select(F.get_json_object("text", "$.id").alias("id"), F.get_json_object("text", "$.aggregationType").alias("how")).collect()
    how = {r["id"]: r["how"] for r in held}
    if odd := sorted(e for e in elements if how.get(e) not in ("SUM", "AVERAGE_SUM_ORG_UNIT")):
        raise ValueError(f"elements that are neither summed nor averaged over units cannot be computed: {', '.join(odd)}")
    units = None
    for level in levels:
        found = api.table("organisationUnits", fields="id", filter=[f"level:eq:{level}"] + [f"path:like:{root}"] * bool(root)).select(F.lit(level).alias("level"), F.get_json_object("text", "$.id").alias("level_unit"))
        units = found if units is None else units.unionByName(found)
    roots = [root] if root else [r["level_unit"] for r in units.where(F.col("level") == min(levels)).collect()]
    if bare := [r["target"] for r in targets.where("t_start is null").collect()]:
        raise ValueError(f"periods without dates cannot be computed: {', '.join(bare)}")
    if since:
        span = targets.agg(F.min("t_start").cast("string").alias("a"), F.max("t_end").cast("string").alias("b")).first()
        news = _values(api, [{"elements": elements, "start": span["a"], "end": span["b"], "roots": roots, "since": since}])
        touched = mapping.changed_targets(news.select(periods.period_start(F.col("period")).alias("start"), periods.period_end(F.col("period")).alias("end")), targets)
        targets = written(targets.join(touched, "target"), f"{folder(spark)}/touched")
    spans = targets.select("target", "place", F.col("t_start").cast("string").alias("a"), F.col("t_end").cast("string").alias("b")).orderBy("place").collect()
    batches = [{"elements": elements, "start": r["a"], "end": r["b"], "roots": roots} for r in spans]
    values = _values(api, batches).where("not deleted").drop("unit").distinct() if batches else _values(api, [])
    values = values.where(F.col("element").isin(elements)).withColumnRenamed("orgUnit", "unit")
    values = written(values.withColumns({"start": periods.period_start(F.col("period")), "end": periods.period_end(F.col("period")), "number": F.trim("value").try_cast("double")}), f"{folder(spark)}/values")
    above = written(mapping.placed_units(mapping.unit_parents(lines, own.identifier("orgunit")), units), f"{folder(spark)}/above")

    def issue(kind: str, rows: DataFrame, key) -> DataFrame:
        return rows.select(key.alias("location_id")).distinct().select(F.lit(kind).alias("kind"), "location_id", F.lit("left out").alias("detail"))

    issues = issue("unsupported_period", values.where("start is null"), F.col("period"))
    dated = facts.to_targets(values.where("start is not null"), targets)
    issues = issues.unionByName(issue("straddling_period", dated.where("issue is not null"), F.col("period")))
    inside = dated.where("target is not null").join(above.select(F.col("unit").alias("_u")).distinct(), F.col("unit") == F.col("_u"), "left")
    issues = issues.unionByName(issue("unmapped_org_unit", inside.where("_u is null"), F.col("unit"))).unionByName(issue("non_numeric_value", inside.where("_u is not null and number is null"), F.concat_ws("/", "element", "unit", "period")))
    good = inside.where("_u is not null and number is not null").withColumn("value", F.col("number"))
    leveled = written(facts.by_level(facts.by_unit(good, [e for e, h in how.items() if h != "SUM"]), above), f"{folder(spark)}/levels")
    annual = periods.annual_factor(F.col("t_start"), F.col("t_end"))
    out = None
    for r in rows:
        found = facts.indicator(leveled, r["numerator"], r["denominator"], r["factor"]).join(targets.select("target", "t_start", "t_end", "place"), "target")
        value = F.col("value") * annual if r["annualized"] else F.col("value")
        element = r["kind"] == "data element"
        figures = [F.lit("") if element else F.col(c).cast("string") for c in ("numerator", "denominator")]
        found = found.select(F.col("place").alias("unit"), F.lit(r["id"]).alias("dx"), F.col("target").alias("pe"), F.col("level_unit").alias("ou"), (F.col("numerator") if element else value).cast("string").alias("value"), figures[0].alias("numerator"), figures[1].alias("denominator"))
        out = found if out is None else out.unionByName(found)
    return out, issues, len(batches)


def _values(api: Server, batches: list[dict]) -> DataFrame:
    return written(api.spark.read.format("unit_values").options(**api.options, batches=json.dumps(batches)).load(), f"{folder(api.spark)}/raw")


def _compared(spark: SparkSession, docs: DataFrame, previous: str, selected: DataFrame, own: Instance, keep_rest: bool) -> tuple[DataFrame, DataFrame]:
    """(docs with their change, and kept earlier ones; ids that are gone within this run's measures, subjects and periods)."""

    def hashed(rows: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("json"), pa.array([content_hash(json.loads(t)) for t in batch.column("json").to_pylist()], pa.string())], names=["id", "json", "hash"])

        shape = rows.select("id", "json").mapInArrow(run, "id string, json string, hash string")
        scope = {"measure": "$.measure", "subject": "$.subject.reference", "period": "$.extension[0].valueString"}
        return shape.select("*", *[F.get_json_object("json", p).alias(c) for c, p in scope.items()])

    before = written(hashed(files.read_lines(spark, previous).select(F.get_json_object("text", "$.id").alias("id"), F.col("text").alias("json"))), f"{folder(spark)}/before")
    now = written(hashed(docs), f"{folder(spark)}/now")
    found = written(merge.compare_runs(now, before, ["measure", "subject", "period"]), f"{folder(spark)}/changes")
    out = docs.join(found, "id")
    if keep_rest:
        kept = found.where("change = 'kept'").join(before.select("id", "json"), "id").select(F.lit(1 << 30).alias("unit"), "id", "json", "change")
        out = out.unionByName(kept, allowMissingColumns=True)
    return written(out, f"{folder(spark)}/compared"), found.where("change = 'removed'").select("id")
