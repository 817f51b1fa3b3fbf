"""Queries over registry documents made from the driver's tables: parsing, edits, builders, imports, text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import naming, scalars
from ..functions.documents import Profile
from ..operators import bake, builders, edits, mapping, places, planning
from ..operators.order import numbered, write_text
from ..sources import files
from ..workspace import folder, written
from . import views
from .catalog import query

P = Profile()


def _k() -> Column:
    return F.col("s_suppkey")



def _text(*parts: object) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _member(name: str, value: Column) -> Column:
    """A member of a JSON object after others, or nothing where the value is null."""
    return F.when(value.isNull(), "").otherwise(F.concat(F.lit(f',"{name}":'), value))


def _quoted(value: object) -> Column:
    return _text('"', value, '"')


def _suppliers(spark, sf_dir) -> DataFrame:
    return views.table(spark, sf_dir, "supplier")


def _place_text() -> Column:
    """A supplier as a document; some lines are no JSON, some have no id, some lack parts."""
    k = _k()
    body = _text(
        '{"resourceType":"Location"', _member("id", F.when(k % 50 != 1, _quoted(_text("s", k)))), ',"meta":{"versionId":"', (k % 5).cast("string"), '"}', _member("name", _quoted(F.col("s_name"))),
        _member("status", F.when(k % 4 == 0, _quoted("inactive")).when(k % 4 == 1, F.lit("7"))), _member("alias", F.when(k % 3 == 0, _text('["A', k, '",5,"x"]')).when(k % 3 == 1, _quoted("x"))),
        ',"type":[{"coding":[{"system":"kinds","code":"facility"}]}],"identifier":[{"system":"other","value":"O"},', _text('{"system":"', P.identifier("pcode"), '","value":"S', k, '"}]'),
        _member("partOf", F.when(k % 6 != 5, _text('{"reference":"Location/', F.when(k % 6 == 4, "").otherwise(_text("n", F.col("s_nationkey"))), '"}'))), _member("managingOrganization", F.when(k % 2 == 0, _text('{"reference":"Organization/o', k % 30, '"}'))),
        _member("position", F.when(k % 7 != 3, _text('{"longitude":', (k % 100 - 50).cast("string"), ',"latitude":', F.when(k % 7 == 2, _quoted("north")).otherwise((k % 60 - 30).cast("string")), "}"))), "}",
    )
    return F.when(k % 50 == 0, _text('{"id":"s', k)).otherwise(body)


def _places(spark, sf_dir) -> DataFrame:
    return _suppliers(spark, sf_dir).select(_k().alias("seq"), _place_text().alias("text"))


_GOOD = "s_suppkey % 50 NOT IN (0, 1)"


@query(f"""SELECT 's' || s_suppkey AS id, s_name AS name, CASE WHEN s_suppkey % 4 = 0 THEN 'inactive' END AS status, 'facility' AS type, 'S' || s_suppkey AS pcode, (s_suppkey % 5)::VARCHAR AS version_id,
    CASE WHEN s_suppkey % 6 < 4 THEN 'n' || s_nationkey END AS part_of, CASE WHEN s_suppkey % 2 = 0 THEN 'o' || s_suppkey % 30 END AS managing_organization,
    CASE WHEN s_suppkey % 3 = 0 THEN 'A' || s_suppkey || '|x' ELSE '' END AS alias, CASE WHEN s_suppkey % 7 NOT IN (2, 3) THEN (s_suppkey % 100 - 50)::DOUBLE END AS lon, CASE WHEN s_suppkey % 7 NOT IN (2, 3) THEN (s_suppkey % 60 - 30)::DOUBLE END AS lat
    FROM supplier WHERE {_GOOD}""")
def q_parse_places(spark, sf_dir):
    flat = places.flatten(_places(spark, sf_dir)).where("id is not null")
    return flat.select("id", "name", "status", "type", "pcode", "version_id", "part_of", "managing_organization", F.array_join("alias", "|").alias("alias"), "lon", "lat")


@query(f"""SELECT kind, count(*)::BIGINT AS n FROM (SELECT 'malformed_field' AS kind FROM supplier WHERE s_suppkey % 50 = 0 UNION ALL SELECT 'missing_id' FROM supplier WHERE s_suppkey % 50 = 1
    UNION ALL SELECT 'malformed_field' FROM supplier WHERE {_GOOD} AND s_suppkey % 3 IN (0, 1) UNION ALL SELECT 'malformed_field' FROM supplier WHERE {_GOOD} AND s_suppkey % 6 = 4
    UNION ALL SELECT 'malformed_field' FROM supplier WHERE {_GOOD} AND s_suppkey % 7 = 2 UNION ALL SELECT 'no_geometry' FROM supplier WHERE {_GOOD} AND s_suppkey % 7 IN (2, 3)) GROUP BY kind""")
def q_parse_issues(spark, sf_dir):
    return places.flatten(_places(spark, sf_dir)).select(F.explode("issues").alias("i")).groupBy("i.kind").agg(F.count("*").alias("n"))


@query(f"SELECT 's' || s_suppkey AS id, true AS same FROM supplier WHERE {_GOOD}")
def q_documents_stay_whole(spark, sf_dir):
    lines = _places(spark, sf_dir)
    return places.flatten(lines).where("id is not null").join(lines.select("seq", "text"), "seq").select("id", (F.col("fhir_json") == F.col("text")).alias("same"))


@query("""SELECT 'o' || s_suppkey AS id, s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'C' || s_suppkey END AS nhfr_code, CASE WHEN s_suppkey % 3 = 0 THEN 'tier' || s_suppkey % 4 END AS facility_level,
    CASE WHEN s_suppkey % 3 = 0 THEN 'Tier ' || s_suppkey % 4 END AS facility_level_text FROM supplier""")
def q_parse_organizations(spark, sf_dir):
    k = _k()
    text = _text(
        '{"resourceType":"Organization","id":"o', k, '","name":"', F.col("s_name"), '"', _member("identifier", F.when(k % 2 == 0, _text('[{"system":"', P.identifier("nhfr-code"), '","value":"C', k, '"}]'))),
        _member("type", F.when(k % 3 == 0, _text('[{"coding":[{"system":"x"}]},{"coding":[{"system":"', P.codes("facility-type"), '","code":"tier', k % 4, '"}],"text":"Tier ', k % 4, '"}]'))), "}",
    )
    return places.flatten_organizations(_suppliers(spark, sf_dir).select(k.alias("seq"), text.alias("text"))).select("id", "name", "nhfr_code", "facility_level", "facility_level_text")


# Edits

_BASE = "SELECT s_suppkey AS k, s_suppkey % 8 AS m, s_name, s_nationkey, s_suppkey % 100 - 50 AS lon, s_suppkey % 60 - 30 AS lat FROM supplier"


def _held(spark, sf_dir) -> DataFrame:
    k = _k()
    text = _text(
        '{"resourceType":"Location","id":"s', k, '","name":"', F.col("s_name"), '","description":"d', k, '","status":"active","type":[{"coding":[{"system":"kinds","code":"facility"}]}],"identifier":[{"system":"',
        P.identifier("pcode"), '","value":"S', k, '"}],"partOf":{"reference":"Location/n', F.col("s_nationkey"), '"},"position":{"longitude":', k % 100 - 50, ',"latitude":', k % 60 - 30, '},"managingOrganization":{"reference":"Organization/o', k % 20, '"}}',
    )
    return _suppliers(spark, sf_dir).select(k.alias("seq"), _text("s", k).alias("id"), text.alias("text"))


def _features(rows: DataFrame, properties: Column, geometry: Column | None = None) -> DataFrame:
    shape = geometry if geometry is not None else F.lit(None).cast("string")
    return rows.select(_k().alias("seq"), properties.alias("properties"), shape.alias("geometry"), F.lit(None).cast("string").alias("feature_id"))


def _edited(spark, sf_dir) -> DataFrame:
    k, m = _k(), _k() % 8
    same = _text('{"id":"s', k, '","name":"', F.when(m == 1, _text("New ", k)).otherwise(F.col("s_name")), '"', F.when(m == 2, ',"description":null').otherwise(""), F.when(m == 3, ',"status":"inactive","part_of":"n0"').otherwise(""),
                 F.when(m == 4, ',"type":"school"').otherwise(""), F.when(m == 5, ',"pcode":""').otherwise(""), F.when(m == 6, _text(',"position_longitude":"', k % 100 - 49, '"')).otherwise(""), F.when(m == 7, ',"position_longitude":null,"position_latitude":null').otherwise(""), ',"depth":9}')
    rows = _suppliers(spark, sf_dir)
    first = _features(rows, same)
    again = _features(rows.where(k % 16 == 1), _text('{"id":"s', k, '","name":"Again"}')).withColumn("seq", F.col("seq") + 1_000_000)
    made = _features(rows.where(k % 10 == 0), _text('{"id":"x', k, '","name":"Made ', k, '","type":"facility"}')).withColumn("seq", F.col("seq") + 2_000_000)
    return edits.changed_documents(edits.rows_of_features(first.unionByName(again).unionByName(made)), _held(spark, sf_dir))


def _field(path: str, column: str = "location") -> Column:
    return F.get_json_object(column, path)


@query(f"""WITH b AS ({_BASE}) SELECT 's' || k AS id, k AS seq, CASE WHEN m = 0 THEN 'unchanged' ELSE 'changed' END AS action, CASE WHEN m = 1 THEN 'New ' || k WHEN m > 0 THEN s_name END AS name,
    CASE WHEN m NOT IN (0, 2) THEN 'd' || k END AS description, CASE WHEN m = 3 THEN 'inactive' WHEN m > 0 THEN 'active' END AS status, CASE WHEN m = 3 THEN 'Location/n0' WHEN m > 0 THEN 'Location/n' || s_nationkey END AS part_of,
    CASE WHEN m = 4 THEN 'school' WHEN m > 0 THEN 'facility' END AS type, CASE WHEN m NOT IN (0, 5) THEN 'S' || k END AS pcode, CASE WHEN m = 6 THEN lon + 1 WHEN m NOT IN (0, 7) THEN lon END::DOUBLE AS longitude FROM b
    UNION ALL SELECT 's' || k, k + 1000000, 'skipped', NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM b WHERE k % 16 = 1
    UNION ALL SELECT 'x' || k, k + 2000000, 'created', 'Made ' || k, NULL, NULL, NULL, 'facility', NULL, NULL FROM b WHERE k % 10 = 0""")
def q_edited_places(spark, sf_dir):
    found = _edited(spark, sf_dir)
    return found.select("id", "seq", "action", _field("$.name").alias("name"), _field("$.description").alias("description"), _field("$.status").alias("status"), _field("$.partOf.reference").alias("part_of"), _field("$.type[0].coding[0].code").alias("type"), _field("$.identifier[0].value").alias("pcode"), _field("$.position.longitude").cast("double").alias("longitude"))


@query(f"""WITH b AS ({_BASE}) SELECT kind, count(*)::BIGINT AS n FROM (SELECT 'duplicate_id' AS kind FROM b WHERE k % 16 = 1 UNION ALL SELECT 'new_location' FROM b WHERE k % 10 = 0) GROUP BY kind""")
def q_edit_issues(spark, sf_dir):
    return _edited(spark, sf_dir).select(F.explode("issues").alias("i")).groupBy("i.kind").agg(F.count("*").alias("n"))


@query("""SELECT 's' || s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN 'town' END AS settlement, CASE WHEN s_suppkey % 3 = 1 THEN 'tier2' END AS level, CASE WHEN s_suppkey % 3 = 2 THEN 'a' || s_suppkey END AS other,
    CASE WHEN s_suppkey % 3 = 2 THEN 'b|c' ELSE '' END AS alias FROM supplier""")
def q_edited_codes(spark, sf_dir):
    k = _k()
    body = _text('{"id":"s', k, '"', F.when(k % 3 == 0, ',"settlement_type":"town"').when(k % 3 == 1, ',"facility_level":"tier2"').otherwise(_text(',"alias":["b","c"],"identifier":"[{\\"system\\":\\"z\\",\\"value\\":\\"a', k, '\\"}]"')), "}")
    found = edits.changed_documents(edits.rows_of_features(_features(_suppliers(spark, sf_dir), body)), _held(spark, sf_dir))
    alias = F.array_join(F.coalesce(F.from_json(_field("$.alias"), "array<string>"), F.array().cast("array<string>")), "|")
    return found.select("id", _field("$.extension[0].valueCode").alias("settlement"), _field("$.type[1].coding[0].code").alias("level"), F.when(_field("$.identifier[0].system") == "z", _field("$.identifier[0].value")).alias("other"), alias.alias("alias"))


def _box(x: Column, y: Column, w: Column) -> Column:
    at = [(x, y), (x + w, y), (x + w, y + 2), (x, y + 2), (x, y)]
    return _text('{"type":"Polygon","coordinates":[[', *[p for i, (a, b) in enumerate(at) for p in (("," if i else "") + "[", a.cast("string"), ",", b.cast("string"), "]")], "]]}")


def _bounded(shape: Column) -> Column:
    """The boundary member of a document."""
    return _text('"extension":[{"url":"', P.boundaries[0], '","valueAttachment":{"contentType":"application/geo+json","data":"', F.regexp_replace(F.base64(shape.cast("binary")), r"\s", ""), '"}}]')


@query("""SELECT 's' || s_suppkey AS id, CASE s_suppkey % 4 WHEN 1 THEN 'changed' ELSE 'unchanged' END AS action, CASE WHEN s_suppkey % 4 = 2 THEN 'geometry_kind_changed' ELSE '' END AS issues FROM supplier""")
def q_edited_boundaries(spark, sf_dir):
    """The same boundary after rounding is no edit, another one is, a point is refused, and no geometry is no edit."""
    k, x, y = _k(), (_k() % 80).cast("double"), (_k() % 40).cast("double")
    rows = _suppliers(spark, sf_dir)
    held = rows.select(k.alias("seq"), _text("s", k).alias("id"), _text('{"resourceType":"Location","id":"s', k, '",', _bounded(_box(x, y, F.lit(2.0))), "}").alias("text"))
    shape = F.when(k % 4 == 0, _box(x, y, F.lit(2.00000001))).when(k % 4 == 1, _box(x, y, F.lit(3.0))).when(k % 4 == 2, _text('{"type":"Point","coordinates":[1,2]}'))
    found = edits.changed_documents(edits.rows_of_features(_features(rows, _text('{"id":"s', k, '"}'), shape)), held)
    return found.select("id", "action", F.array_join(F.transform("issues", lambda i: i["kind"]), ",").alias("issues"))


@query("""SELECT 's' || s_suppkey AS id, CASE WHEN s_suppkey % 20 >= 15 THEN 'organization_missing' ELSE '' END AS issues, CASE WHEN s_suppkey % 20 < 15 AND s_suppkey % 3 = 0 THEN 'false' WHEN s_suppkey % 20 < 15 AND s_suppkey % 3 = 1 THEN 'true' END AS active,
    CASE WHEN s_suppkey % 20 < 15 AND s_suppkey % 3 = 1 THEN 'N' || s_suppkey END AS nhfr_code FROM supplier""")
def q_edited_organizations(spark, sf_dir):
    k = _k()
    orgs = spark.range(15).select(F.col("id").alias("seq"), _text("o", F.col("id")).alias("id"), _text('{"resourceType":"Organization","id":"o', F.col("id"), '","name":"Org","active":true}').alias("text"))
    body = _text('{"id":"s', k, '"', F.when(k % 3 == 0, ',"status":"inactive"').when(k % 3 == 1, _text(',"nhfr_code":"N', k, '"')).otherwise(',"status":"active"'), "}")
    found = edits.changed_documents(edits.rows_of_features(_features(_suppliers(spark, sf_dir), body)), _held(spark, sf_dir), orgs)
    return found.select("id", F.array_join(F.transform("issues", lambda i: i["kind"]), ",").alias("issues"), _field("$.active", "organization").alias("active"), _field("$.identifier[0].value", "organization").alias("nhfr_code"))


@query("""SELECT 'x' || s_suppkey AS id, 'org-x' || s_suppkey AS organization, 'Organization/org-x' || s_suppkey AS managing, 'Made ' || s_suppkey AS name FROM supplier WHERE s_suppkey % 10 = 0""")
def q_made_organizations(spark, sf_dir):
    """A new facility gets an organization of its own, which comes before it."""
    k = _k()
    rows = _features(_suppliers(spark, sf_dir).where(k % 10 == 0), _text('{"id":"x', k, '","name":"Made ', k, '","type":"facility"}'))
    held = _held(spark, sf_dir)
    found = edits.changed_documents(edits.rows_of_features(rows), held, held.limit(0))
    first = edits.documents(found).where("place = 0").select("seq", F.get_json_object("text", "$.id").alias("made"))
    return found.join(first, "seq").select("id", F.col("made").alias("organization"), _field("$.managingOrganization.reference").alias("managing"), _field("$.name", "organization").alias("name"))


@query("""SELECT status, count(*)::BIGINT AS n FROM (SELECT CASE WHEN s_suppkey % 5 = 0 THEN 'no_position' WHEN s_suppkey % 5 = 1 THEN 'already_indexed' ELSE 'indexed' END AS status FROM supplier) GROUP BY status""")
def q_cell_backfill(spark, sf_dir):
    k = _k()
    cell = _text('"extension":[{"url":"', P.extension("spatial-index"), '","extension":[{"url":"system","valueCode":"geohash"},{"url":"level","valueUnsignedInt":4},{"url":"cell","valueString":"u4pr"}]}],')
    text = _text("{", F.when(k % 5 == 1, cell).otherwise(""), '"id":"s', k, '"', F.when(k % 5 != 0, _text(',"position":{"longitude":', k % 100 - 50, ',"latitude":', k % 60 - 30, "}")).otherwise(""), "}")
    done = edits.backfill_cells(_suppliers(spark, sf_dir).select(k.alias("seq"), text.alias("text")), [("geohash", 4)])
    return done.groupBy("status").agg(F.count("*").alias("n"))


# Builders and imports


@query("""WITH v AS (SELECT s_suppkey AS k, 's' || s_suppkey AS id, CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE s_suppkey * 1000 - 5000 END AS quantity, CASE WHEN s_suppkey % 7 = 0 THEN 0 ELSE s_suppkey % 50 END AS pixels FROM supplier)
SELECT 'src-' || id || '-2025' AS id, quantity::INTEGER AS quantity, 'Location/' || id AS subject FROM v WHERE quantity IS NOT NULL AND pixels > 0 AND quantity BETWEEN 0 AND 2147483647""")
def q_population_groups(spark, sf_dir):
    k = _k()
    sums = _suppliers(spark, sf_dir).select(_text("s", k).alias("id"), F.when(k % 9 != 0, k * 1000 - 5000).alias("quantity"), F.when(k % 7 == 0, 0).otherwise(k % 50).alias("pixels"), (k % 9 == 0).alias("incomplete"))
    docs, _ = builders.population_groups(sums, "src", 2025)
    return docs.select("id", F.get_json_object("json", "$.quantity").cast("int").alias("quantity"), F.get_json_object("json", "$.characteristic[0].valueReference.reference").alias("subject"))


@query("""WITH v AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE s_suppkey * 1000 - 5000 END AS quantity, CASE WHEN s_suppkey % 7 = 0 THEN 0 ELSE s_suppkey % 50 END AS pixels FROM supplier)
SELECT kind, count(*)::BIGINT AS n FROM (SELECT CASE WHEN quantity IS NULL THEN 'no_boundary' WHEN pixels = 0 THEN 'no_pixels' WHEN quantity < 0 THEN 'quantity_out_of_range' END AS kind FROM v) WHERE kind IS NOT NULL GROUP BY kind""")
def q_population_issues(spark, sf_dir):
    k = _k()
    sums = _suppliers(spark, sf_dir).select(_text("s", k).alias("id"), F.when(k % 9 != 0, k * 1000 - 5000).alias("quantity"), F.when(k % 7 == 0, 0).otherwise(k % 50).alias("pixels"), (k % 9 == 0).alias("incomplete"))
    return builders.population_groups(sums, "src", 2025)[1].groupBy("kind").agg(F.count("*").alias("n"))


@query("""SELECT 'measure-i-' || p_partkey AS id, CASE WHEN p_partkey % 4 = 0 THEN 'cohort' WHEN p_partkey % 3 = 0 THEN 'proportion' ELSE 'ratio' END AS scoring, p_name AS title, '#{a' || p_partkey || '}' AS numerator FROM part""")
def q_measure_documents(spark, sf_dir):
    k = F.col("p_partkey")
    rows = views.table(spark, sf_dir, "part").select(_text("i_", k).alias("id"), F.col("p_name").alias("name"), _text("#{a", k, "}").alias("numerator"), F.when(k % 4 == 0, "1").otherwise("#{b}").alias("denominator"), F.when(k % 3 == 0, 100.0).otherwise(1.0).alias("factor"))
    found = builders.measures(rows)
    return found.select("id", F.get_json_object("json", "$.scoring.coding[0].code").alias("scoring"), F.get_json_object("json", "$.title").alias("title"), F.get_json_object("json", "$.group[0].population[0].criteria.expression").alias("numerator"))


@query("""SELECT 'report-i-o' || o_orderkey || '-20240101-20240131' AS id, round(o_totalprice / 7.0 * 1e10) / 1e10 AS score, (o_orderkey % 50)::INTEGER AS numerator, CASE WHEN o_orderkey % 3 = 0 THEN 'a,b' ELSE '' END AS strata FROM orders""")
def q_report_documents(spark, sf_dir):
    k, day = F.col("o_orderkey"), F.lit("2024-01-01").cast("date")
    rows = views.table(spark, sf_dir, "orders").select(F.lit("i").alias("indicator"), _text("o", k).alias("subject"), day.alias("start"), F.lit("2024-01-31").cast("date").alias("end"), (k % 50).cast("double").alias("numerator"), F.lit(7.0).alias("denominator"), F.col("o_totalprice").cast("double").alias("value"), F.lit(7.0).alias("factor"))
    labels = F.explode(F.array(F.lit("b"), F.lit("a")))
    strata = rows.where(F.expr("cast(substring(subject, 2) as bigint) % 3 = 0")).select("indicator", "subject", "start", labels.alias("label"), F.lit(1).alias("count"))
    found = builders.reports(rows, strata)
    texts = F.from_json(F.get_json_object("json", "$.group[0].stratifier[0].stratum"), "array<struct<value:struct<text:string>>>")
    return found.select("id", F.get_json_object("json", "$.group[0].measureScore.value").cast("double").alias("score"), F.get_json_object("json", "$.group[0].population[0].count").cast("int").alias("numerator"), F.coalesce(F.array_join(F.transform(texts, lambda t: t["value"]["text"]), ","), F.lit("")).alias("strata"))


@query("""SELECT 1::BIGINT AS level, 'u-r' || r_regionkey AS id, 1 AS place, NULL AS part_of, 'active' AS status, NULL AS alias FROM region
    UNION ALL SELECT 2, 'u-n' || n_nationkey, 1, 'Location/u-r' || n_regionkey, CASE WHEN n_nationkey % 5 = 0 THEN 'inactive' ELSE 'active' END, CASE WHEN n_nationkey % 2 = 0 THEN 'N' || n_nationkey END FROM nation
    UNION ALL SELECT 3, 'org-u-s' || s_suppkey, 0, NULL, NULL, NULL FROM supplier UNION ALL SELECT 3, 'u-s' || s_suppkey, 1, 'Location/u-n' || s_nationkey, 'active', NULL FROM supplier""")
def q_unit_documents(spark, sf_dir):
    n, r = views.table(spark, sf_dir, "nation"), views.table(spark, sf_dir, "region")
    none = F.lit(None).cast("string")
    at = [F.lit(None).cast("double").alias(c) for c in ("longitude", "latitude")]
    units = r.select(_text("r", F.col("r_regionkey")).alias("id"), F.col("r_name").alias("name"), F.col("r_name").alias("shortName"), F.lit(1).cast("long").alias("level"), none.alias("parent"), none.alias("closedDate"), *at)
    k = F.col("n_nationkey")
    units = units.unionAll(n.select(_text("n", k), F.col("n_name"), F.when(k % 2 == 0, _text("N", k)).otherwise(F.col("n_name")), F.lit(2).cast("long"), _text("r", F.col("n_regionkey")), F.when(k % 5 == 0, "2020-01-01"), *at))
    units = units.unionAll(_suppliers(spark, sf_dir).select(_text("s", _k()), F.col("s_name"), F.col("s_name"), F.lit(3).cast("long"), _text("n", F.col("s_nationkey")), none, *at))
    return builders.unit_places(units, 3, "u-").select("level", "id", "place", F.get_json_object("json", "$.partOf.reference").alias("part_of"), F.get_json_object("json", "$.status").alias("status"), F.get_json_object("json", "$.alias[0]").alias("alias"))


@query("""SELECT 'c-' || replace(lower(r_name), ' ', '-') AS id, 'c' AS part_of, r_name AS name, 1 AS level FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM nation)
    UNION ALL SELECT 'c', NULL, 'C', 0 UNION ALL SELECT DISTINCT 'c-' || replace(lower(r_name), ' ', '-') || '-' || regexp_replace(lower(n_name), '[^a-z0-9]+', '-', 'g'), 'c-' || replace(lower(r_name), ' ', '-'), n_name, 2 FROM nation JOIN region ON n_regionkey = r_regionkey""")
def q_minted_units(spark, sf_dir):
    n, r = views.table(spark, sf_dir, "nation"), views.table(spark, sf_dir, "region")
    rows = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.lit("C").alias("a"), F.initcap("r_name").alias("_b"), F.col("r_name").alias("b"), F.col("n_name").alias("c"))
    return bake.mint(rows, ["a", "b", "c"])


@query("SELECT 'x-' || p_size AS id, count(DISTINCT p_brand)::BIGINT AS n FROM part GROUP BY p_size HAVING count(DISTINCT p_brand) > 1")
def q_minted_collisions(spark, sf_dir):
    units = views.table(spark, sf_dir, "part").select(_text("x-", F.col("p_size")).alias("id"), F.lit("x").alias("part_of"), F.col("p_brand").alias("name"), F.lit(1).alias("level")).distinct()
    return bake.collisions(units).select("id", "n")


@query("""SELECT 's' || s_suppkey AS unit, 'p' || s_suppkey % 40 AS location FROM supplier WHERE s_suppkey % 3 <> 0 QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY s_suppkey DESC) = 1
    UNION ALL SELECT 'shared', 'p' || (SELECT max(s_suppkey) FROM supplier WHERE s_suppkey % 3 <> 0) % 40""")
def q_unit_mapping(spark, sf_dir):
    k = _k()
    text = _text('{"resourceType":"Location","id":"p', k % 40, '","identifier":[{"system":"other","value":"no"},{"system":"u","value":"', F.when(k % 3 != 0, _text("s", k)).otherwise("none"), '"},{"system":"', F.when(k % 3 != 0, "u").otherwise("v"), '","value":"shared"}]}')
    return mapping.unit_mapping(_suppliers(spark, sf_dir).select(k.alias("seq"), text.alias("text")), "u").where("unit <> 'none'").select("unit", "location")


@query("""WITH u AS (SELECT n_nationkey AS k FROM nation) SELECT 'u' || k AS unit, CASE WHEN k % 5 <> 0 THEN 'u' || (k - 1) END AS parent FROM u""")
def q_unit_parents(spark, sf_dir):
    k = F.col("n_nationkey")
    text = _text('{"resourceType":"Location","id":"p', k, '","identifier":[{"system":"u","value":"u', k, '"}]', F.when(k % 5 != 0, _text(',"partOf":{"reference":"Location/p', k - 1, '"}')).otherwise(',"partOf":{"reference":"Location/gone"}'), "}")
    return mapping.unit_parents(views.table(spark, sf_dir, "nation").select(k.alias("seq"), text.alias("text")), "u")


def _analytics(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    e = views.table(spark, sf_dir, "events")
    rows = e.select("event_id", F.col("event_type").alias("dx"), _text("s", F.col("user_id") % 40).alias("ou"))
    items = spark.createDataFrame([("click",), ("view",), ("purchase",)], "id string")
    units = spark.range(30).select(_text("s", F.col("id")).alias("unit"), _text("p", F.col("id")).alias("location"), F.lit("x").alias("name"))
    return rows, items, units


@query("SELECT event_id, 'p' || user_id % 40 AS location FROM events WHERE event_type IN ('click', 'view', 'purchase') AND user_id % 40 < 30")
def q_matched_values(spark, sf_dir):
    return mapping.matched(*_analytics(spark, sf_dir))[0].select("event_id", "location")


@query("""SELECT kind, location_id, count(*)::BIGINT AS n FROM (SELECT 'unexpected_indicator' AS kind, event_type AS location_id FROM events WHERE event_type NOT IN ('click', 'view', 'purchase')
    UNION ALL SELECT DISTINCT 'unmapped_org_unit', 's' || user_id % 40 FROM events WHERE event_type IN ('click', 'view', 'purchase') AND user_id % 40 >= 30) GROUP BY ALL""")
def q_unmatched_values(spark, sf_dir):
    return mapping.matched(*_analytics(spark, sf_dir))[1].groupBy("kind", "location_id").agg(F.count("*").alias("n"))


@query("""SELECT count(*)::BIGINT AS written, count(DISTINCT user_id)::BIGINT AS locations, count(DISTINCT event_type)::BIGINT AS periods, sum(event_id % 3)::BIGINT AS stratified,
    (count(*) FILTER (event_id % 4 = 0))::BIGINT AS new, (count(*) FILTER (event_id % 4 = 1))::BIGINT AS changed, (count(*) FILTER (event_id % 4 = 2))::BIGINT AS unchanged FROM events""")
def q_run_tallies(spark, sf_dir):
    k = F.col("event_id")
    rows = views.table(spark, sf_dir, "events").select(F.col("user_id").alias("subject"), F.col("event_type").alias("period"), (k % 3).alias("stratifiers"), F.when(k % 4 == 0, "new").when(k % 4 == 1, "changed").when(k % 4 == 2, "unchanged").alias("change"))
    return mapping.run_tallies(rows)


@query("SELECT p_size AS level, count(*)::BIGINT AS n, CASE WHEN p_size < 20 THEN 'admin units' WHEN p_size = 20 THEN 'facilities' ELSE 'skipped' END AS role FROM part GROUP BY p_size")
def q_level_counts(spark, sf_dir):
    return mapping.level_counts(views.table(spark, sf_dir, "part").select(F.col("p_size").alias("level")), 20)


@query("""SELECT scoring, count(*)::BIGINT AS n FROM (SELECT CASE p_partkey % 4 WHEN 0 THEN 'data element counts' WHEN 1 THEN 'reporting rates' WHEN 2 THEN 'ratio' ELSE 'cohort' END AS scoring FROM part) GROUP BY scoring""")
def q_scoring_counts(spark, sf_dir):
    k = F.col("p_partkey") % 4
    return mapping.scoring_counts(views.table(spark, sf_dir, "part").select(F.when(k == 0, "data element").when(k == 1, "reporting rate").otherwise("indicator").alias("kind"), F.when(k == 2, "ratio").otherwise("cohort").alias("scoring")))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'https://registry.example.org/CodeSystem/x/indicator-group:g' || p_size WHEN 1 THEN 'https://registry.example.org/CodeSystem/x/data-element-group:g' || p_size
    ELSE 'https://registry.example.org/CodeSystem/x/data-element-group-set/a:g' || p_size || ',https://registry.example.org/CodeSystem/x/data-element-group-set/b:g' || p_size END AS topics FROM part""")
def q_topics(spark, sf_dir):
    k = F.col("p_partkey") % 3
    sets = F.when(k == 2, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array().cast("array<string>"))
    group = F.array(F.struct(_text("g", F.col("p_size")).alias("id"), F.col("p_brand").alias("name"), sets.alias("sets")))
    found = mapping.topics(F.when(k == 0, "indicator").otherwise("data element"), group, naming.Instance("x"))
    return views.table(spark, sf_dir, "part").select("p_partkey", F.array_join(F.transform(found, lambda t: F.concat_ws(":", t["system"], t["code"])), ",").alias("topics"))


@query("""SELECT strftime(d, '%Y%m') AS target FROM (SELECT DISTINCT o_orderdate::DATE AS d FROM orders WHERE o_orderkey % 7 = 0) WHERE year(d) = 1995 GROUP BY 1""")
def q_changed_targets(spark, sf_dir):
    from ..functions import periods

    day = F.col("o_orderdate").cast("date")
    values = views.table(spark, sf_dir, "orders").where(F.col("o_orderkey") % 7 == 0).select(day.alias("start"), day.alias("end"))
    codes = spark.createDataFrame([(f"1995{m:02}",) for m in range(1, 13)], "target string")
    return mapping.changed_targets(values, codes.withColumns({"t_start": periods.period_start(F.col("target")), "t_end": periods.period_end(F.col("target"))}))


# Text files, scalars and planning


@query("SELECT (row_number() OVER (ORDER BY s_name, s_suppkey) - 1)::BIGINT AS place, 's' || s_suppkey AS id FROM supplier")
def q_lines_in_order(spark, sf_dir):
    """Written in order as one compressed file, read again in the order of its lines."""
    path = f"{folder(spark)}/lines.ndjson.gz"
    write_text(_suppliers(spark, sf_dir).select("s_name", "s_suppkey", _text('{"id":"s', _k(), '"}').alias("text")), path, ["s_name", "s_suppkey"])
    back = written(files.read_lines(spark, path), f"{folder(spark)}/back")
    return numbered(back, ["seq"]).select("place", F.get_json_object("text", "$.id").alias("id"))


@query("SELECT 's' || s_suppkey AS id, s_name AS name, s_nationkey::VARCHAR AS nation FROM supplier WHERE s_nationkey::VARCHAR = '7'")
def q_rows_where(spark, sf_dir):
    """CSV rows, all text, and those whose cell equals a value."""
    path = f"{folder(spark)}/rows.csv"
    _suppliers(spark, sf_dir).select(_text("s", _k()).alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")).write.option("header", True).csv(path)
    return files.read_rows(spark, path).where(F.col("nation") == "7")


@query("SELECT 's' || s_suppkey AS id, s_name AS name FROM supplier")
def q_feature_lines(spark, sf_dir):
    path = f"{folder(spark)}/features.geojsonl"
    text = _text('{"type":"Feature","properties":{"id":"s', _k(), '","name":"', F.col("s_name"), '"},"geometry":{"type":"Point","coordinates":[1,2]}}')
    _suppliers(spark, sf_dir).select(text.alias("value")).write.text(path)
    return files.read_features(spark, path).select(F.get_json_object("properties", "$.id").alias("id"), F.get_json_object("properties", "$.name").alias("name"))


@query("SELECT n_regionkey AS bundle, 'n' || n_nationkey AS id FROM nation")
def q_bundle_resources(spark, sf_dir):
    entry = _text('{"resource":{"id":"n', F.col("n_nationkey"), '"}}')
    lines = views.table(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").alias("seq")).agg(_text('{"resourceType":"Bundle","entry":[', F.array_join(F.collect_list(entry), ","), "]}").alias("text"))
    return files.expand_bundles(lines).select(F.col("seq.line").alias("bundle"), F.get_json_object("text", "$.id").alias("id"))


@query("SELECT event_type AS dx, 's' || user_id AS ou, round(value, 2)::VARCHAR AS value FROM events")
def q_analytics_rows(spark, sf_dir):
    row = _text('["s', F.col("user_id"), '","', F.col("event_type"), '","', F.round("value", 2).cast("string"), '","202401"]')
    answers = views.table(spark, sf_dir, "events").groupBy((F.col("event_id") % 50).alias("k")).agg(_text('{"headers":[{"name":"ou"},{"name":"dx"},{"name":"value"},{"name":"pe"}],"rows":[', F.array_join(F.collect_list(row), ","), "]}").alias("text"))
    return files.read_analytics(answers).select("dx", "ou", "value")


@query("""SELECT event_id, CASE WHEN event_id % 6 IN (0, 5) THEN NULL ELSE epoch(date_trunc('second', ts))::BIGINT - CASE event_id % 6 WHEN 1 THEN 7200 WHEN 2 THEN -5400 ELSE 0 END END AS seconds, CASE WHEN event_id % 6 IN (0, 5) THEN NULL WHEN event_id % 6 = 3 THEN 250000000 ELSE 0 END::INTEGER AS nanos FROM events""")
def q_instants(spark, sf_dir):
    k = F.col("event_id") % 6
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.when(k == 0, "").when(k == 1, "+02:00").when(k == 2, "-01:30").when(k == 3, ".25Z").when(k == 4, "Z").otherwise("+25:00"))
    found = scalars.instant_key(text)
    return views.table(spark, sf_dir, "events").select("event_id", found["seconds"].alias("seconds"), found["nanos"].alias("nanos"))


@query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS utc, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d') WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+01:00' END AS server, 'W/"' || event_id || '"' AS tag FROM events""")
def q_server_times(spark, sf_dir):
    k, whole = F.col("event_id") % 4, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = F.when(k == 2, F.concat(whole, F.lit("+01:00"))).when(k == 3, F.date_format("ts", "dd.MM.yyyy HH:mm")).otherwise(whole)
    return views.table(spark, sf_dir, "events").select("event_id", scalars.format_utc(F.col("ts")).alias("utc"), naming.server_time(text, k != 0).alias("server"), scalars.if_match(F.col("event_id").cast("string")).alias("tag"))


@query("SELECT p_partkey, regexp_matches(p_name, '^[A-Za-z0-9.-]{1,64}$') AS plain, CASE WHEN p_partkey % 2 = 0 THEN '2024-01-0' || (1 + p_size % 9) || '/2024-02-01' ELSE '2024Q' || p_size END AS label FROM part")
def q_ids_and_labels(spark, sf_dir):
    code = F.when(F.col("p_partkey") % 2 == 0, _text("2024010", 1 + F.col("p_size") % 9, "-20240201")).otherwise(_text("2024Q", F.col("p_size")))
    return views.table(spark, sf_dir, "part").select("p_partkey", scalars.is_fhir_id(F.col("p_name")).alias("plain"), naming.period_label(code).alias("label"))


@query("""WITH i AS (SELECT p_partkey - 1 AS place FROM part WHERE p_partkey BETWEEN 1 AND 25), c AS (SELECT place // 10 AS chunk, count(*) AS ids FROM i GROUP BY 1), l AS (SELECT * FROM (VALUES (1, 5), (2, 400)) t(level, units)),
b AS (SELECT *, greatest(20000 // (ids * units), 1) AS size FROM c, l) SELECT level::INTEGER AS level, chunk::BIGINT AS chunk, sum(ceil(p.n::DOUBLE / size))::BIGINT AS requests, sum(p.n)::BIGINT AS periods FROM b, (VALUES (36), (4)) p(n) GROUP BY ALL""")
def q_request_units(spark, sf_dir):
    k = F.col("p_partkey")
    ids = views.table(spark, sf_dir, "part").where(k.between(1, 25)).select(_text("i", k).alias("id"), (k - 1).alias("place"))
    codes = [f"{2020 + m // 12}{m % 12 + 1:02}" for m in range(36)] + [f"2024Q{q}" for q in range(1, 5)]
    periods = spark.createDataFrame([(p, i) for i, p in enumerate(codes)], "period string, place int")
    found = planning.request_units(ids, periods, [(1, 5), (2, 400)])
    return found.groupBy("level", "chunk").agg(F.count("*").alias("requests"), F.sum(F.size("periods")).alias("periods"))


@query("""SELECT 's' || s_suppkey AS unit, CASE WHEN s_suppkey % 6 = 0 THEN 'set,two,three' WHEN s_suppkey % 2 = 0 THEN 'set,two' WHEN s_suppkey % 3 = 0 THEN 'set,three' ELSE 'set' END AS groups FROM supplier""")
def q_memberships(spark, sf_dir):
    rows = _suppliers(spark, sf_dir)

    def group(key: str, place: int, where: Column) -> DataFrame:
        return rows.where(where).agg(F.collect_list(_text("s", _k())).alias("units")).select(F.lit(key).alias("id"), F.lit(key.title()).alias("name"), F.lit(place).alias("place"), "units")

    groups = group("two", 0, _k() % 2 == 0).unionByName(group("three", 1, _k() % 3 == 0)).unionByName(group("set", 2, F.lit(True)))
    return planning.memberships(groups, group("set", 0, F.lit(True))).select("unit", F.array_join(F.transform("groups", lambda g: g["id"]), ",").alias("groups"))
