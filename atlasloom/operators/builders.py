"""Documents built from rows, as nested columns and to_json: population groups, measures, reports, places of a unit tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.documents import Profile
from ..functions.naming import Instance


def _json(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields))


def group_id(source: str, subject: Column, year: int) -> Column:
    return F.concat_ws("-", F.lit(source), subject, F.lit(str(year)))


def population_groups(sums: DataFrame, source: str, year: int, profile: Profile | None = None) -> tuple[DataFrame, DataFrame]:
    """(id, json of each population group; issues). sums: id, quantity, pixels, incomplete.

    No group is written for a subject without pixels, with an id that is too long or malformed, or a quantity beyond 32 bits.
    """
    own = profile or Profile()
    rows = sums.withColumn("_g", group_id(source, F.col("id"), year))
    kind = (
        F.when(F.length("_g") > 64, "group_id_too_long").when(~F.col("_g").rlike(r"^[A-Za-z0-9.\-]{1,64}$"), "group_id_invalid").when(F.col("quantity").isNull() & F.col("incomplete"), "no_boundary")
        .when(F.coalesce("pixels", F.lit(0)) == 0, "no_pixels").when(~F.col("quantity").between(0, 2147483647), "quantity_out_of_range")
    )
    rows = rows.withColumn("_kind", kind)
    doc = _json(
        F.lit("Group").alias("resourceType"), F.col("_g").alias("id"), F.lit("person").alias("type"), F.lit(False).alias("actual"), F.col("quantity").cast("int").alias("quantity"),
        F.array(F.struct(F.struct(F.array(F.struct(F.lit(own.codes("population")).alias("system"), F.lit("location").alias("code"))).alias("coding")).alias("code"), F.struct(F.concat(F.lit("Location/"), "id").alias("reference")).alias("valueReference"), F.lit(False).alias("exclude"))).alias("characteristic"),
    )
    partial = rows.where("_kind is null and incomplete").select(F.lit("rollup_incomplete").alias("kind"), F.col("id").alias("location_id"), F.lit("a part below has no figure").alias("detail"))
    issues = rows.where("_kind is not null").select(F.col("_kind").alias("kind"), F.col("id").alias("location_id"), F.col("_g").alias("detail")).unionByName(partial)
    return rows.where("_kind is null").select(F.col("_g").alias("id"), doc.alias("json")), issues


def measures(indicators: DataFrame, profile: Profile | None = None) -> DataFrame:
    """(id, json) of a measure per indicator: id, name, numerator, denominator, factor."""
    own = profile or Profile()
    key = F.concat(F.lit("measure-"), F.replace("id", F.lit("_"), F.lit("-")))
    scoring = F.when(F.col("denominator") == "1", "cohort").when(F.col("factor") == 100, "proportion").otherwise("ratio")
    population = [F.struct(F.struct(F.array(F.struct(F.lit(c).alias("code"))).alias("coding")).alias("code"), F.struct(F.lit("text/x-indicator").alias("language"), F.col(c).alias("expression")).alias("criteria")) for c in ("numerator", "denominator")]
    doc = _json(F.lit("Measure").alias("resourceType"), key.alias("id"), F.lit(f"{own.base}/Measure/").alias("url"), F.lit("active").alias("status"), F.col("name").alias("title"), F.struct(F.array(F.struct(scoring.alias("code"))).alias("coding")).alias("scoring"), F.array(F.struct(F.array(*population).alias("population"))).alias("group"))
    return indicators.select(key.alias("id"), scoring.alias("scoring"), doc.alias("json"))


def reports(values: DataFrame, strata: DataFrame | None = None) -> DataFrame:
    """(id, json) of a report per measure, subject and period: indicator, subject, start, end, numerator, denominator, value, factor.

    strata: indicator, subject, start, label, count, joined as sorted lists; one without its total finds no report.
    """
    key = F.concat_ws("-", F.lit("report"), "indicator", "subject", F.date_format("start", "yyyyMMdd"), F.date_format("end", "yyyyMMdd"))
    rows = values.withColumns({"id": key, "score": F.round(F.try_divide("value", "factor") * 1e10) / 1e10})
    if strata is not None:
        grouped = strata.groupBy("indicator", "subject", "start").agg(F.array_sort(F.collect_list(F.struct(F.struct(F.col("label").alias("text")).alias("value"), F.struct(F.col("count").alias("value")).alias("measureScore")))).alias("stratum"))
        rows = rows.join(grouped, ["indicator", "subject", "start"], "left")
    else:
        rows = rows.withColumn("stratum", F.lit(None).cast("array<struct<value:struct<text:string>>>"))
    figures = [F.struct(F.struct(F.array(F.struct(F.lit(c).alias("code"))).alias("coding")).alias("code"), F.round(c).cast("int").alias("count")) for c in ("numerator", "denominator")]
    period = F.struct(F.date_format("start", "yyyy-MM-dd").alias("start"), F.date_format("end", "yyyy-MM-dd").alias("end"))
    parts = F.when(F.col("stratum").isNotNull(), F.array(F.struct("stratum")))
    doc = _json(F.lit("MeasureReport").alias("resourceType"), "id", F.lit("complete").alias("status"), F.lit("summary").alias("type"), F.concat(F.lit("Measure/measure-"), "indicator").alias("measure"), F.struct(F.concat(F.lit("Location/"), "subject").alias("reference")).alias("subject"), period.alias("period"), F.array(F.struct(F.array(*figures).alias("population"), F.struct(F.col("score").alias("value")).alias("measureScore"), parts.alias("stratifier"))).alias("group"))
    return rows.select("id", doc.alias("json"))


def unit_places(units: DataFrame, facility_level: int, prefix: str = "", profile: Profile | None = None) -> DataFrame:
    """(seq, id, kind, json): a place per unit (and an organization before each facility). units: id, name, shortName, level, parent, closedDate, longitude, latitude."""
    own = profile or Profile()
    key, parent = F.concat(F.lit(prefix), "id"), F.concat(F.lit(prefix), "parent")
    facility = F.col("level") >= facility_level
    alias = F.when(F.col("shortName") != F.col("name"), F.array("shortName"))
    status = F.when(F.col("closedDate").isNull(), "active").otherwise("inactive")
    identifier = F.array(F.struct(F.lit(own.identifier("unit-uid")).alias("system"), F.col("id").alias("value")))
    kind = F.when(facility, "facility").otherwise("admin-unit")
    place = F.when(F.col("longitude").isNotNull() & F.col("latitude").isNotNull(), F.struct("longitude", "latitude"))
    up = F.when(F.col("parent").isNotNull(), F.struct(F.concat(F.lit("Location/"), parent).alias("reference")))
    managing = F.when(facility, F.struct(F.concat(F.lit("Organization/org-"), key).alias("reference")))
    location = _json(F.lit("Location").alias("resourceType"), key.alias("id"), identifier.alias("identifier"), status.alias("status"), F.col("name"), alias.alias("alias"), F.array(F.struct(F.array(F.struct(kind.alias("code"))).alias("coding"))).alias("type"), place.alias("position"), managing.alias("managingOrganization"), up.alias("partOf"))
    organization = _json(F.lit("Organization").alias("resourceType"), F.concat(F.lit("org-"), key).alias("id"), identifier.alias("identifier"), (status == "active").alias("active"), F.col("name"))
    both = F.array_compact(F.array(F.when(facility, F.struct(F.lit(0).alias("place"), F.concat(F.lit("org-"), key).alias("id"), organization.alias("json"))), F.struct(F.lit(1).alias("place"), key.alias("id"), location.alias("json"))))
    return units.select("level", F.col("id").alias("unit"), F.explode(both).alias("d")).select("level", "unit", "d.*")


ITEM = "id string, uid string, kind string, name string, code string, description string, numerator string, numerator_text string, denominator string, denominator_text string, factor double, type_name string, annualized boolean, decimals int, groups array<struct<id:string,name:string,sets:array<string>>>, updated string"
_SYSTEMS = {"indicator": "indicator", "data element": "data-element", "reporting rate": "data-set"}


def measure_documents(items: DataFrame, instance: Instance, publisher: str | None = None, utc: bool = False) -> DataFrame:
    """(id, kind, scoring, json) of the whole measure of each item of a statistics server (columns of ITEM)."""
    from ..functions.naming import server_time
    from .mapping import topics

    scoring = F.when(F.trim("denominator") == "1", "cohort").when(F.col("factor") == 100, "proportion").otherwise("ratio")
    key = F.concat(F.lit(f"{instance.name}-"), F.replace("id", F.lit("_"), F.lit("-")))

    def system(suffix: str) -> Column:
        return F.coalesce(*[F.when(F.col("kind") == kind, instance.identifier(name + suffix)) for kind, name in _SYSTEMS.items()])

    def extra(url: str, value: str, column: Column) -> Column:
        kinds = {"valueDecimal": "double", "valueString": "string", "valueBoolean": "boolean", "valueInteger": "int"}
        return F.when(column.isNotNull(), F.struct(F.lit(url).alias("url"), *[(column if k == value else F.lit(None)).cast(t).alias(k) for k, t in kinds.items()]))

    def population(code: str, display: str, text: str, expression: str) -> Column:
        return F.struct(_coding(instance.base + "/CodeSystem/measure-population", F.lit(code), F.lit(display)).alias("code"), F.col(text).alias("description"), F.struct(F.lit("text/x-indicator").alias("language"), F.col(expression).alias("expression")).alias("criteria"))

    extension = F.array(F.struct(F.lit(instance.base + "/StructureDefinition/indicator").alias("url"), F.array_compact(F.array(extra("factor", "valueDecimal", F.col("factor")), extra("indicatorType", "valueString", F.col("type_name")), extra("annualized", "valueBoolean", F.col("annualized")), extra("decimals", "valueInteger", F.col("decimals")))).alias("extension")))
    identifier = F.array_compact(F.array(F.struct(F.lit("official").alias("use"), system("").alias("system"), F.col("uid").alias("value")), F.when(F.col("code").isNotNull(), F.struct(F.lit(None).cast("string").alias("use"), system("-code").alias("system"), F.col("code").alias("value")))))
    topic = F.transform(topics(F.col("kind"), F.coalesce("groups", F.array().cast("array<struct<id:string,name:string,sets:array<string>>>")), instance), lambda t: F.struct(F.when(t["code"].isNotNull(), F.array(t)).alias("coding"), t["display"].alias("text")))
    pair = F.array(population("numerator", "Numerator", "numerator_text", "numerator"), population("denominator", "Denominator", "denominator_text", "denominator"))
    one = F.array(population("initial-population", "Initial Population", "numerator_text", "numerator"))
    doc = _json(
        F.lit("Measure").alias("resourceType"), key.alias("id"), F.struct(F.array(F.struct(F.lit(instance.base + "/tags").alias("system"), F.lit(instance.name).alias("code"))).alias("tag")).alias("meta"), extension.alias("extension"), F.concat(F.lit(instance.base + "/Measure/"), key).alias("url"), identifier.alias("identifier"),
        F.col("name").alias("title"), F.lit("active").alias("status"), server_time(F.col("updated"), F.lit(utc)).alias("date"), F.lit(publisher).cast("string").alias("publisher"), "description", F.when(F.size(topic) > 0, topic).alias("topic"), _coding("http://hl7.org/fhir/resource-types", F.lit("Location")).alias("subjectCodeableConcept"),
        _coding("http://terminology.hl7.org/CodeSystem/measure-scoring", scoring, F.initcap(scoring)).alias("scoring"), F.array(F.struct(F.when(scoring == "cohort", one).otherwise(pair).alias("population"))).alias("group"),
    )
    return items.select(key.alias("id"), "kind", scoring.alias("scoring"), doc.alias("json"))


def _coding(system: str, code: Column, display: Column | None = None) -> Column:
    return F.struct(F.array(F.struct(F.lit(system).alias("system"), code.alias("code"), (display if display is not None else F.lit(None).cast("string")).alias("display"))).alias("coding"))


def report_documents(rows: DataFrame, instance: Instance, strata: DataFrame | None = None, source: str = "analytics", campaign: str | None = None, date: str | None = None, reporter: str | None = None) -> tuple[DataFrame, DataFrame]:
    """((unit, id, json, subject, period, stratifiers); issues) of values that were met with their items and places.

    rows: unit, dx, ou, pe, location, location_name, start, end, value, numerator, denominator (text), scoring, factor. strata: dx, ou, pe,
    breakdown, breakdown_name, option, option_name and figures as text. Counts that are no numbers or too large are left out and reported, fractional
    ones rounded and reported; a value that is no finite number gives no report.
    """
    from ..functions.naming import period_label
    from ..functions.scalars import is_fhir_id, score, whole_number

    key = F.concat_ws("-", F.lit(instance.name), F.replace("dx", F.lit("_"), F.lit("-")), "ou", "pe")
    value = F.col("value").try_cast("double")
    usable = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))

    def figure(code: str, display: str, column: Column) -> tuple[Column, Column]:
        n, issue = whole_number(F.nullif(F.trim(column), F.lit("")))
        return F.when(n.isNotNull(), F.struct(_coding(instance.base + "/CodeSystem/measure-population", F.lit(code), F.lit(display)).alias("code"), n.alias("count"))), issue

    def figures(frame: DataFrame) -> DataFrame:
        first = F.when(F.trim("numerator") != "", F.col("numerator")).otherwise(F.col("value"))
        cohort, problem = figure("initial-population", "Initial Population", first)
        up, above = figure("numerator", "Numerator", F.col("numerator"))
        down, below = figure("denominator", "Denominator", F.col("denominator"))
        one = F.col("scoring") == "cohort"
        found = F.array_compact(F.when(one, F.array(cohort)).otherwise(F.array(up, down)))
        kinds = F.array_compact(F.when(one, F.array(problem)).otherwise(F.array(above, below)))
        return frame.withColumns({"id": key, "_population": F.when(F.size(found) > 0, found), "_kinds": F.when(usable, kinds).otherwise(F.array(F.lit("bad_number"))), "_score": F.struct(score(value, F.col("factor")).alias("value")), "_usable": usable})

    totals = figures(rows).withColumn("_fits", is_fhir_id(F.col("id")))
    issues = totals.where("not _fits").select(F.lit("invalid_id").alias("kind"), F.col("id").alias("location_id"), F.lit("no id of a document; left out").alias("detail"))
    issues = issues.unionByName(totals.where("_fits").select(F.explode("_kinds").alias("kind"), F.col("id").alias("location_id"), F.col("value").alias("detail")))
    totals = totals.where("_fits and _usable")
    if strata is not None:
        shown = figures(strata.join(rows.select("dx", "scoring", "factor").distinct(), "dx"))
        issues = issues.unionByName(shown.select(F.explode("_kinds").alias("kind"), F.concat_ws("/", "id", F.concat_ws(":", "breakdown", "option")).alias("location_id"), F.col("value").alias("detail")))
        system = F.concat(F.lit(instance.dimension() + "/"), "breakdown")
        stratum = F.struct(F.struct(F.array(F.struct(system.alias("system"), F.col("option").alias("code"), F.col("option_name").alias("display"))).alias("coding"), F.col("option_name").alias("text")).alias("value"), F.col("_population").alias("population"), F.col("_score").alias("measureScore"))
        by = shown.where("_usable").groupBy("id", "breakdown", "breakdown_name").agg(F.array_sort(F.collect_list(F.struct(F.col("option_name").alias("text"), stratum.alias("s")))).alias("l"))
        coded = F.array(F.struct(F.array(F.struct(F.lit(instance.dimension()).alias("system"), F.col("breakdown").alias("code"), F.col("breakdown_name").alias("display"))).alias("coding"), F.col("breakdown_name").alias("text")))
        each = by.select("id", F.struct("breakdown", F.struct(coded.alias("code"), F.transform("l", lambda x: x["s"]).alias("stratum")).alias("s")).alias("b"))
        all_ = each.groupBy("id").agg(F.transform(F.array_sort(F.collect_list("b")), lambda b: b["s"]).alias("_strata"))
        issues = issues.unionByName(by.join(totals.select("id"), "id", "left_anti").select(F.lit("stratum_without_total").alias("kind"), F.col("id").alias("location_id"), F.col("breakdown").alias("detail")))
        totals = totals.join(all_, "id", "left")
    else:
        totals = totals.withColumn("_strata", F.lit(None).cast("array<string>"))
    url = instance.base + "/StructureDefinition/"
    none = F.lit(None).cast("string")
    parts = [F.struct(F.lit(url + "period").alias("url"), period_label(F.col("pe")).alias("valueString"), none.alias("valueCode"), F.struct(none.alias("reference")).alias("valueReference"))]
    parts += [F.struct(F.lit(url + "campaign").alias("url"), none.alias("valueString"), none.alias("valueCode"), F.struct(F.lit(campaign).alias("reference")).alias("valueReference"))] * bool(campaign)
    parts += [F.struct(F.lit(url + "source").alias("url"), none.alias("valueString"), F.lit(source).alias("valueCode"), F.struct(none.alias("reference")).alias("valueReference"))]
    clean = [F.struct(p["url"].alias("url"), p["valueString"].alias("valueString"), p["valueCode"].alias("valueCode"), F.when(p["valueReference"]["reference"].isNotNull(), p["valueReference"]).alias("valueReference")) for p in parts]
    doc = _json(
        F.lit("MeasureReport").alias("resourceType"), "id", F.struct(F.array(F.struct(F.lit(instance.base + "/tags").alias("system"), F.lit(instance.name).alias("code"))).alias("tag")).alias("meta"), F.array(*clean).alias("extension"), F.lit("complete").alias("status"), F.lit("summary").alias("type"),
        F.concat(F.lit(f"{instance.base}/Measure/{instance.name}-"), F.replace("dx", F.lit("_"), F.lit("-"))).alias("measure"), F.struct(F.concat(F.lit("Location/"), "location").alias("reference"), F.col("location_name").alias("display")).alias("subject"), F.lit(date).cast("string").alias("date"),
        F.when(F.lit(reporter is not None), F.struct(F.lit(reporter).cast("string").alias("display"))).alias("reporter"), F.struct(F.col("start").cast("string").alias("start"), F.col("end").cast("string").alias("end")).alias("period"),
        F.array(F.struct(F.col("_population").alias("population"), F.col("_score").alias("measureScore"), F.col("_strata").alias("stratifier"))).alias("group"),
    )
    return totals.select("unit", "id", doc.alias("json"), "location", F.concat(F.lit("Location/"), "location").alias("subject"), period_label(F.col("pe")).alias("period"), F.coalesce(F.size("_strata"), F.lit(0)).alias("stratifiers"), F.col("dx")), issues
