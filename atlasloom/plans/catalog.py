"""Queries over the driver's tables, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cells, periods, scalars
from ..operators import bundles, facts, hierarchy, merge, raster, reports
from ..workspace import folder, written
from . import views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its name, with the SQL of its rows."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


_tables: dict[tuple[str, str, str], DataFrame] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make) -> DataFrame:
    """A table that several queries of a session read, made by the first of them."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _tables:
        _tables[key] = written(make(), f"{folder(spark)}/{name}")
    return _tables[key]


def _tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry with its hierarchy resolved: once a session, as a run does."""
    return _once(spark, sf_dir, "tree", lambda: hierarchy.with_country(hierarchy.with_levels(hierarchy.resolve(views.locs(spark, sf_dir)))))


# Hierarchy


@query(f"WITH RECURSIVE {views.CLOSURE} SELECT admin1_name, count(*)::BIGINT AS n FROM tree WHERE type = 'facility' GROUP BY admin1_name")
def q_facilities_by_admin1(spark, sf_dir):
    return _tree(spark, sf_dir).where("type = 'facility'").groupBy("admin1_name").agg(F.count("*").alias("n"))


@query(f"WITH RECURSIVE {views.CLOSURE} SELECT id, '/' || CASE WHEN ancestors = '' THEN '' ELSE ancestors || '/' END || id AS path FROM tree")
def q_hierarchy_paths(spark, sf_dir):
    return _tree(spark, sf_dir).select("id", "path")


@query(f"WITH RECURSIVE {views.CLOSURE} SELECT id, ancestors, depth FROM tree")
def q_hierarchy_ancestors(spark, sf_dir):
    return _tree(spark, sf_dir).select("id", F.array_join("ancestor_ids", "/").alias("ancestors"), "depth")


@query(f"WITH RECURSIVE {views.CLOSURE} SELECT depth, count(*)::BIGINT AS n FROM tree GROUP BY depth")
def q_hierarchy_depth(spark, sf_dir):
    return _tree(spark, sf_dir).groupBy("depth").agg(F.count("*").alias("n"))


@query(f"""WITH RECURSIVE {views.CLOSURE} SELECT id, CASE WHEN type = 'admin-unit' THEN CASE WHEN id LIKE 'r%' THEN 0 ELSE 1 END END::INTEGER AS admin_level,
    admin0_name, admin1_name FROM tree""")
def q_hierarchy_admin_levels(spark, sf_dir):
    return _tree(spark, sf_dir).select("id", "admin_level", "admin0_name", "admin1_name")


@query(f"""WITH RECURSIVE {views.CLOSURE} SELECT id, coalesce(root_code, 'unknown') AS country,
    CASE WHEN type = 'admin-unit' THEN CASE WHEN id LIKE 'r%' THEN '0' ELSE '1' END ELSE 'site' END AS tier FROM tree""")
def q_hierarchy_country_tier(spark, sf_dir):
    return _tree(spark, sf_dir).select("id", "country", "tier")


@query(f"WITH {views.LOCS} SELECT id, part_of FROM locs WHERE part_of IS NOT NULL AND part_of NOT IN (SELECT id FROM locs)")
def q_orphans(spark, sf_dir):
    return hierarchy.orphans(views.locs(spark, sf_dir)).select("id", "part_of")


@query("SELECT p_partkey::VARCHAR AS id, p_partkey + 1000000000 AS seq FROM part WHERE p_partkey % 100 = 7")
def q_duplicate_ids(spark, sf_dir):
    return hierarchy.duplicates(views.chain(spark, sf_dir))


def _dropped(spark, sf_dir, kind: str) -> DataFrame:
    return _once(spark, sf_dir, "chains", lambda: hierarchy.resolve(views.chain(spark, sf_dir))).where(F.col("dropped") == kind).select("id")


@query(f"WITH RECURSIVE {views.CHAIN} SELECT k::VARCHAR AS id FROM ring")
def q_cycles(spark, sf_dir):
    return _dropped(spark, sf_dir, "cycle")


@query(f"WITH RECURSIVE {views.CHAIN} SELECT k::VARCHAR AS id FROM parents WHERE k NOT IN (SELECT k FROM down) AND k NOT IN (SELECT k FROM ring)")
def q_unreachable(spark, sf_dir):
    return _dropped(spark, sf_dir, "unreachable_ancestor")


@query(f"WITH RECURSIVE {views.CHAIN} SELECT k::VARCHAR AS id FROM down WHERE depth >= 12")
def q_too_deep(spark, sf_dir):
    return _dropped(spark, sf_dir, "too_deep")


@query(f"""WITH RECURSIVE {views.CHAIN} SELECT kind, count(*)::BIGINT AS n FROM (
    SELECT 'duplicate_id' AS kind FROM part WHERE p_partkey % 100 = 7 UNION ALL SELECT 'orphan' FROM chain1 WHERE part_of NOT IN (SELECT k FROM chain1) UNION ALL SELECT 'cycle' FROM ring UNION ALL SELECT 'too_deep' FROM down WHERE depth >= 12
    UNION ALL SELECT 'unreachable_ancestor' FROM parents WHERE k NOT IN (SELECT k FROM down) AND k NOT IN (SELECT k FROM ring)) GROUP BY kind""")
def q_issue_counts(spark, sf_dir):
    records = views.chain(spark, sf_dir)
    return reports.issue_counts(hierarchy.hierarchy_issues(records, _once(spark, sf_dir, "chains", lambda: hierarchy.resolve(records))))


@query("SELECT kind, seq FROM (SELECT event_type AS kind, event_id AS seq, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events) WHERE n <= 1000")
def q_issue_cap(spark, sf_dir):
    return reports.capped_issues(views.table(spark, sf_dir, "events").select(F.col("event_type").alias("kind"), F.col("event_id").alias("seq"))).select("kind", "seq")


@query(f"WITH {views.LOCS} SELECT pcode, string_agg(id, ', ' ORDER BY id) AS ids, count(*)::BIGINT AS n FROM locs WHERE pcode IS NOT NULL GROUP BY pcode HAVING count(*) > 1")
def q_duplicate_pcode(spark, sf_dir):
    return reports.duplicate_codes(views.locs(spark, sf_dir))


# Cells, order and extent

_HILBERT = f"""WITH RECURSIVE {views.LOCS},
s AS (SELECT id, 15 AS b, least(65535, greatest(0, round((lon + 180.0) / 360.0 * 65535.0)))::BIGINT AS x, least(65535, greatest(0, round((lat + 90.0) / 180.0 * 65535.0)))::BIGINT AS y, 0::BIGINT AS d FROM locs WHERE lon IS NOT NULL
      UNION ALL SELECT id, b - 1, CASE WHEN ry = 0 THEN (CASE WHEN rx = 1 THEN 65535 - y ELSE y END) ELSE x END, CASE WHEN ry = 0 THEN (CASE WHEN rx = 1 THEN 65535 - x ELSE x END) ELSE y END,
             d + (1::BIGINT << (2 * b)) * xor(3 * rx, ry) FROM (SELECT *, (x >> b) & 1 AS rx, (y >> b) & 1 AS ry FROM s WHERE b >= 0)),
h AS (SELECT id, d AS hilbert FROM s WHERE b = -1)"""


def _placed(spark, sf_dir) -> DataFrame:
    return views.locs(spark, sf_dir).where("lon is not null")


@query(_HILBERT + " SELECT id, hilbert FROM h")
def q_hilbert_key(spark, sf_dir):
    return _placed(spark, sf_dir).select("id", cells.hilbert_key(F.col("lon"), F.col("lat")).alias("hilbert"))


@query(_HILBERT + " SELECT l.type, h.id, row_number() OVER (PARTITION BY l.type ORDER BY hilbert, seq)::INTEGER AS place FROM h JOIN locs l USING (id)")
def q_hilbert_order(spark, sf_dir):
    rows = _placed(spark, sf_dir).withColumn("hilbert", cells.hilbert_key(F.col("lon"), F.col("lat")))
    return reports.output_order(rows, ["type"]).select("type", "id", "place")


def _tile_sql(level: int) -> str:
    return f"""t AS (SELECT id, least({(1 << level) - 1}, greatest(0, floor((lon + 180.0) / 360.0 * {float(1 << level)})))::BIGINT AS x,
      least({(1 << level) - 1}, greatest(0, floor((0.5 - ln((1.0 + sin(lat * pi() / 180.0)) / (1.0 - sin(lat * pi() / 180.0))) / (4.0 * pi())) * {float(1 << level)})))::BIGINT AS y FROM locs WHERE lon IS NOT NULL AND lon < 180)"""


def _quadkey_sql(level: int) -> str:
    return " || ".join(f"(((x >> {b}) & 1) + 2 * ((y >> {b}) & 1))::VARCHAR" for b in range(level - 1, -1, -1))


@query(f"WITH {views.LOCS}, {_tile_sql(18)} SELECT id, {_quadkey_sql(18)} AS quadkey FROM t")
def q_quadkey18(spark, sf_dir):
    return _placed(spark, sf_dir).where("lon < 180").select("id", cells.quadkey(F.col("lon"), F.col("lat"), 18).alias("quadkey"))


@query(f"WITH {views.LOCS}, {_tile_sql(12)} SELECT substr({_quadkey_sql(12)}, 1, 3) AS cell, count(*)::BIGINT AS n FROM t GROUP BY ALL")
def q_quadkey_rollup(spark, sf_dir):
    key = cells.quadkey(F.col("lon"), F.col("lat"), 12)
    return _placed(spark, sf_dir).where("lon < 180").groupBy(F.substring(key, 1, 3).alias("cell")).agg(F.count("*").alias("n"))


def _geohash_sql(length: int) -> str:
    bits = 5 * length
    wide, high = (bits + 1) // 2, bits // 2
    bit = [f"((x >> {wide - 1 - k // 2}) & 1)" if k % 2 == 0 else f"((y >> {high - 1 - k // 2}) & 1)" for k in range(bits)]
    letters = " || ".join(f"substr('{cells.BASE32}', ({' + '.join(f'{16 >> j} * {bit[5 * c + j]}' for j in range(5))} + 1)::INTEGER, 1)" for c in range(length))
    return f"""g AS (SELECT id, least({(1 << wide) - 1}, greatest(0, floor((lon + 180.0) / 360.0 * {float(1 << wide)})))::BIGINT AS x,
      least({(1 << high) - 1}, greatest(0, floor((lat + 90.0) / 180.0 * {float(1 << high)})))::BIGINT AS y FROM locs WHERE lon IS NOT NULL) SELECT id, {letters} AS geohash FROM g"""


@query(f"WITH {views.LOCS}, {_geohash_sql(8)}")
def q_geohash8(spark, sf_dir):
    return _placed(spark, sf_dir).select("id", cells.geohash(F.col("lon"), F.col("lat"), 8).alias("geohash"))


@query(f"""WITH RECURSIVE {views.CLOSURE} SELECT coalesce(root_code, 'unknown') AS country, min(lon) AS xmin, min(lat) AS ymin, max(lon) AS xmax, max(lat) AS ymax,
    count(*)::BIGINT AS n, (count(*) FILTER (lon IS NULL))::BIGINT AS n_without FROM tree GROUP BY 1""")
def q_bbox_by_country(spark, sf_dir):
    return reports.bounds(_tree(spark, sf_dir), ["country"])


@query(f"WITH {views.LOCS} SELECT type, CASE WHEN lon IS NULL THEN 'none' ELSE 'point' END AS geom_type, count(*)::BIGINT AS n FROM locs GROUP BY ALL")
def q_geom_type_counts(spark, sf_dir):
    return views.locs(spark, sf_dir).groupBy("type", F.when(F.col("lon").isNull(), "none").otherwise("point").alias("geom_type")).agg(F.count("*").alias("n"))


@query(f"WITH {views.LOCS} SELECT id, lon, lat FROM locs WHERE lon BETWEEN 3 AND 40 AND lat BETWEEN -10 AND 30")
def q_envelope_filter(spark, sf_dir):
    return reports.in_envelope(views.locs(spark, sf_dir), 3, -10, 40, 30).select("id", "lon", "lat")


@query(f"""WITH RECURSIVE {views.CLOSURE} SELECT coalesce(root_code, 'unknown') AS country, type, count(*)::BIGINT AS n FROM tree GROUP BY ALL HAVING count(*) < 100""")
def q_small_partitions(spark, sf_dir):
    return reports.small_partitions(_tree(spark, sf_dir), ["country", "type"])


@query(r"""SELECT DISTINCT p_type AS value, CASE WHEN s = '' THEN 'empty' ELSE s END AS segment
    FROM (SELECT p_type, regexp_replace(regexp_replace(p_type, '[/\\<>:"|?*\x01-\x1F\x7F]', '_', 'g'), '[. ]+$', '') AS s FROM part)""")
def q_partition_segments(spark, sf_dir):
    return views.table(spark, sf_dir, "part").select(F.col("p_type").alias("value")).distinct().select("value", scalars.path_segment(F.col("value")).alias("segment"))


@query(f"WITH {views.LOCS} SELECT round(lon / 3.0 * 1e7) / 1e7 AS lon7, round(lat / 3.0 * 1e7) / 1e7 AS lat7, count(*)::BIGINT AS n FROM locs WHERE lon IS NOT NULL GROUP BY ALL")
def q_round7_dedup(spark, sf_dir):
    return _placed(spark, sf_dir).groupBy(scalars.round7(F.col("lon") / 3.0).alias("lon7"), scalars.round7(F.col("lat") / 3.0).alias("lat7")).agg(F.count("*").alias("n"))


# Merge and comparison

_MERGE = """old AS (SELECT o_orderkey::VARCHAR AS id, o_orderkey AS seq, o_orderstatus AS body FROM orders WHERE o_orderkey % 10 <> 0),
inc AS (SELECT (o_orderkey - o_orderkey % 2)::VARCHAR AS id, o_orderkey AS seq, o_orderpriority AS body FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 14 = 1),
last AS (SELECT id, max(seq) AS seq, arg_max(body, seq) AS body FROM inc GROUP BY id)"""


def _old_and_new(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    o, k = views.table(spark, sf_dir, "orders"), F.col("o_orderkey")
    old = o.where(k % 10 != 0).select(k.cast("string").alias("id"), k.alias("seq"), F.col("o_orderstatus").alias("body"))
    new = o.where((k % 7 == 0) | (k % 14 == 1)).select((k - k % 2).cast("string").alias("id"), k.alias("seq"), F.col("o_orderpriority").alias("body"))
    return old, new


@query(f"WITH {_MERGE} SELECT id, seq, body, 0 AS source FROM old WHERE id NOT IN (SELECT id FROM last) UNION ALL SELECT id, seq, body, 1 FROM last")
def q_snapshot_merge(spark, sf_dir):
    return merge.upsert(*_old_and_new(spark, sf_dir))


@query(f"""WITH {_MERGE} SELECT ((SELECT count(*) FROM old WHERE id NOT IN (SELECT id FROM last)) + (SELECT count(*) FROM last))::BIGINT AS total,
    (SELECT count(*) FROM last WHERE id NOT IN (SELECT id FROM old))::BIGINT AS added, (SELECT count(*) FROM last WHERE id IN (SELECT id FROM old))::BIGINT AS updated""")
def q_merge_stats(spark, sf_dir):
    return merge.merge_stats(*_old_and_new(spark, sf_dir))


@query("SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN event_id % 2 = 0 THEN 'Z' ELSE '+00:00' END AS watermark FROM events WHERE event_id % 5 <> 0 ORDER BY date_trunc('second', ts) DESC, event_id LIMIT 1")
def q_watermark(spark, sf_dir):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("event_id") % 5 == 0, " malformed").when(F.col("event_id") % 2 == 0, "Z").otherwise("+00:00"))
    return merge.watermark(views.table(spark, sf_dir, "events").select(text.alias("t"), F.col("event_id").alias("seq")), "t")


_RUNS = """a AS (SELECT o_orderkey AS id, o_orderstatus AS scope, o_orderpriority AS hash FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderstatus <> 'P'),
b AS (SELECT o_orderkey AS id, o_orderstatus AS scope, CASE WHEN o_orderkey % 4 = 0 THEN 'old' ELSE o_orderpriority END AS hash FROM orders WHERE o_orderkey % 5 <> 0),
c AS (SELECT coalesce(a.id, b.id) AS id, CASE WHEN b.id IS NULL THEN 'new' WHEN a.id IS NULL AND b.scope IN (SELECT scope FROM a) THEN 'removed' WHEN a.id IS NULL THEN 'kept'
      WHEN a.hash = b.hash THEN 'unchanged' ELSE 'changed' END AS change FROM a FULL JOIN b ON a.id = b.id)"""


def _runs(spark, sf_dir) -> DataFrame:
    o, k = views.table(spark, sf_dir, "orders"), F.col("o_orderkey")
    now = o.where((k % 3 != 0) & (F.col("o_orderstatus") != "P")).select(k.alias("id"), F.col("o_orderstatus").alias("scope"), F.col("o_orderpriority").alias("hash"))
    before = o.where(k % 5 != 0).select(k.alias("id"), F.col("o_orderstatus").alias("scope"), F.when(k % 4 == 0, "old").otherwise(F.col("o_orderpriority")).alias("hash"))
    return merge.compare_runs(now, before, ["scope"])


@query(f"WITH {_RUNS} SELECT id, change FROM c")
def q_rerun_compare(spark, sf_dir):
    return _runs(spark, sf_dir)


@query(f"WITH {_RUNS} SELECT id FROM c WHERE change = 'removed'")
def q_removed_ids(spark, sf_dir):
    return _runs(spark, sf_dir).where("change = 'removed'").select("id")


# Periods, facts and indicators

_CODES = ["strftime(d, '%Y')", "strftime(d, '%Y%m')", "strftime(d, '%Y%m%d')", "strftime(d, '%Y') || lpad(((month(d) + 1) // 2)::VARCHAR, 2, '0') || 'B'", "strftime(d, '%Y') || 'Q' || quarter(d)", "strftime(d, '%Y') || 'S' || ((month(d) + 5) // 6)", "isoyear(d) || 'W' || week(d)"]
_PERIODS = f"""days AS (SELECT DISTINCT o_orderdate::DATE AS d FROM orders),
codes AS ({" UNION ".join(f"SELECT {c} AS code, {s}::DATE AS first, ({s} + {n} - INTERVAL 1 DAY)::DATE AS last FROM days" for c, s, n in zip(_CODES, ["date_trunc('year', d)", "date_trunc('month', d)", "d", "make_date(year(d), 2 * ((month(d) + 1) // 2) - 1, 1)", "date_trunc('quarter', d)", "make_date(year(d), 6 * ((month(d) + 5) // 6) - 5, 1)", "date_trunc('week', d)"], ["INTERVAL 1 YEAR", "INTERVAL 1 MONTH", "INTERVAL 1 DAY", "INTERVAL 2 MONTH", "INTERVAL 3 MONTH", "INTERVAL 6 MONTH", "INTERVAL 7 DAY"], strict=True))})"""


def _codes(spark, sf_dir) -> DataFrame:
    d = F.col("d")
    year = F.date_format(d, "yyyy")
    thursday = F.date_add(F.date_trunc("week", d).cast("date"), 3)
    all_codes = F.array(
        year, F.date_format(d, "yyyyMM"), F.date_format(d, "yyyyMMdd"), F.concat(year, F.lpad(F.floor((F.month(d) + 1) / 2).cast("string"), 2, "0"), F.lit("B")), F.concat(year, F.lit("Q"), F.quarter(d)),
        F.concat(year, F.lit("S"), F.floor((F.month(d) + 5) / 6)), F.concat(F.year(thursday).cast("string"), F.lit("W"), F.weekofyear(d)),
    )
    return views.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct().select(F.explode(all_codes).alias("code")).distinct()


@query(f"WITH {_PERIODS} SELECT code, first::VARCHAR AS first, last::VARCHAR AS last FROM codes")
def q_period_days(spark, sf_dir):
    return _codes(spark, sf_dir).select("code", periods.period_start(F.col("code")).cast("string").alias("first"), periods.period_end(F.col("code")).cast("string").alias("last"))


@query(f"WITH {_PERIODS} SELECT kind, count(*)::BIGINT AS n, ceil(count(*) / 12.0)::BIGINT AS batches FROM (SELECT length(regexp_extract(code, '^[0-9]*'))::VARCHAR || regexp_replace(regexp_replace(code, '^[0-9]+', ''), '[0-9]+', '#', 'g') AS kind FROM codes) GROUP BY kind")
def q_period_kind_batches(spark, sf_dir):
    return _codes(spark, sf_dir).groupBy(periods.period_kind(F.col("code")).alias("kind")).agg(F.count("*").alias("n")).withColumn("batches", F.ceil(F.col("n") / 12).cast("long"))


_ABOVE = """above AS (SELECT 's' || s_suppkey AS unit, 's' || s_suppkey AS level_unit, 3 AS level FROM supplier UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey, 2 FROM supplier
    UNION ALL SELECT 's' || s_suppkey, 'r' || n_regionkey, 1 FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""
_UNIT = f"""WITH {views.FACTS}, {_ABOVE}, placed AS (SELECT *, CASE WHEN day <= DATE '2024-01-31' AND day >= DATE '2024-01-01' THEN '202401' WHEN day BETWEEN DATE '2024-02-01' AND DATE '2024-02-29' THEN '202402' END AS target FROM facts),
unit_values AS (SELECT target, unit, element, option, attribute, CASE WHEN element = 'click' THEN sum(value) / count(value) ELSE sum(value) END::DOUBLE AS value FROM placed WHERE target IS NOT NULL GROUP BY target, unit, element, option, attribute),
levels AS (SELECT target, level, level_unit, element, option, attribute, sum(value) AS value FROM unit_values JOIN above USING (unit) GROUP BY ALL)"""


def _targets(spark, codes: list[str]) -> DataFrame:
    t = spark.createDataFrame([(c, i) for i, c in enumerate(codes)], "target string, place int")
    return t.withColumns({"t_start": periods.period_start(F.col("target")), "t_end": periods.period_end(F.col("target"))})


def _above(spark, sf_dir) -> DataFrame:
    tree = _tree(spark, sf_dir).where("id like 's%'")
    pairs = tree.select(F.col("id").alias("unit"), F.explode(F.array_append("ancestor_ids", F.col("id"))).alias("level_unit"))
    return pairs.withColumn("level", F.when(F.col("level_unit").like("r%"), 1).when(F.col("level_unit").like("n%"), 2).otherwise(3))


def _dated(spark, sf_dir) -> DataFrame:
    return views.facts(spark, sf_dir).withColumns({"start": periods.period_start(F.col("period")), "end": periods.period_end(F.col("period"))})


def _levels(spark, sf_dir, average: list[str]) -> DataFrame:
    values = facts.to_targets(_dated(spark, sf_dir), _targets(spark, ["202401", "202402"]))
    return facts.by_level(facts.by_unit(values, average), _above(spark, sf_dir))


@query(_UNIT.replace("CASE WHEN element = 'click' THEN sum(value) / count(value) ELSE sum(value) END", "sum(value)") + " SELECT target, level, level_unit, element, sum(value)::BIGINT AS total FROM levels GROUP BY ALL")
def q_raw_sum_by_level(spark, sf_dir):
    return _levels(spark, sf_dir, []).groupBy("target", "level", "level_unit", "element").agg(F.sum("value").cast("long").alias("total"))


@query(_UNIT + " SELECT target, level, level_unit, option, round(sum(value), 3) AS average FROM levels WHERE element = 'click' GROUP BY ALL")
def q_raw_avg_sum_ou(spark, sf_dir):
    return _levels(spark, sf_dir, ["click"]).where("element = 'click'").groupBy("target", "level", "level_unit", "option").agg(F.round(F.sum("value"), 3).alias("average"))


@query(f"""WITH {views.FACTS}, w AS (SELECT isoyear(day) || 'W' || week(day) AS period, date_trunc('week', day)::DATE AS a, (date_trunc('week', day) + INTERVAL 6 DAY)::DATE AS b FROM facts)
SELECT period, count(*)::BIGINT AS n FROM w WHERE NOT (a >= DATE '2024-01-01' AND b <= DATE '2024-01-31') AND NOT (a >= DATE '2024-02-01' AND b <= DATE '2024-02-29')
  AND (b >= DATE '2024-01-01' AND a <= DATE '2024-02-29') GROUP BY period""")
def q_straddling_periods(spark, sf_dir):
    day = F.to_date("period", "yyyyMMdd")
    week = F.concat(F.year(F.date_add(F.date_trunc("week", day).cast("date"), 3)).cast("string"), F.lit("W"), F.weekofyear(day))
    values = views.facts(spark, sf_dir).withColumn("period", week).withColumns({"start": periods.period_start(F.col("period")), "end": periods.period_end(F.col("period"))})
    met = facts.to_targets(values, _targets(spark, ["202401", "202402"]))
    return met.where("issue is not null").groupBy("period").agg(F.count("*").alias("n"))


_ITEM = "sum(value) FILTER (element = '{}')"


@query(_UNIT + f""" SELECT target, level, level_unit, round(100.0 * n / d, 6) AS value, n AS numerator, d AS denominator FROM (SELECT target, level, level_unit,
    coalesce({_ITEM.format('purchase')}, 0) + coalesce(sum(value) FILTER (element = 'signup' AND option = '1'), 0) AS n, {_ITEM.format('view')} AS d,
    {_ITEM.format('purchase')} IS NULL AND sum(value) FILTER (element = 'signup' AND option = '1') IS NULL AS gone FROM levels GROUP BY ALL) WHERE NOT gone AND d <> 0""")
def q_indicator_coverage(spark, sf_dir):
    out = facts.indicator(_levels(spark, sf_dir, ["click"]), "#{purchase} + #{signup.1}", "#{view}", 100.0)
    return out.withColumn("value", F.round("value", 6))


@query(_UNIT + f""" SELECT target, level, level_unit, round({_ITEM.format('view')} / {_ITEM.format('click')} * CASE target WHEN '202401' THEN 366.0 / 31 ELSE 366.0 / 29 END, 6) AS value FROM levels GROUP BY target, level, level_unit
    HAVING {_ITEM.format('view')} IS NOT NULL AND {_ITEM.format('click')} <> 0""")
def q_indicator_annualised(spark, sf_dir):
    factor = periods.annual_factor(periods.period_start(F.col("target")), periods.period_end(F.col("target")))
    out = facts.indicator(_levels(spark, sf_dir, ["click"]), "#{view}", "#{click}", annual=factor)
    return out.select("target", "level", "level_unit", F.round("value", 6).alias("value"))


@query(_UNIT + """ SELECT target, level, level_unit, round(coalesce(sum(value) FILTER (element = 'view' AND option = '3'), 0) * 2, 6) AS numerator FROM levels WHERE level = 3 AND option <> '2' GROUP BY ALL
    HAVING count(*) FILTER (element = 'view' AND option = '3') > 0 OR count(*) FILTER (element = 'nothing') > 0""")
def q_indicator_missing_rule(spark, sf_dir):
    values = _levels(spark, sf_dir, ["click"]).where("level = 3 and option <> '2'")
    return facts.indicator(values, "(#{view.3} - #{nothing}) * 2", "1").select("target", "level", "level_unit", F.round("numerator", 6).alias("numerator"))


_STRATA = _UNIT + """, totals AS (SELECT target, level_unit, sum(value)::BIGINT AS total FROM levels WHERE element = 'view' AND level = 2 GROUP BY ALL),
strata AS (SELECT target, level_unit, option AS label, sum(value)::BIGINT::VARCHAR AS value FROM levels WHERE element IN ('view', 'click') AND level IN (1, 2) AND option <> '0' AND element = 'view' GROUP BY ALL)"""


def _strata(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    rows = _levels(spark, sf_dir, ["click"]).where("element = 'view'")
    totals = rows.where("level = 2").groupBy("target", "level_unit").agg(F.sum("value").cast("long").alias("total"))
    strata = rows.where("level in (1, 2) and option <> '0'").groupBy("target", "level_unit", F.col("option").alias("label")).agg(F.sum("value").cast("long").cast("string").alias("value"))
    return facts.with_strata(totals, strata, ["target", "level_unit"])


@query(_STRATA + " SELECT t.target, t.level_unit, t.total, string_agg(label || '=' || value, ';' ORDER BY label || '=' || value) AS strata FROM totals t LEFT JOIN strata s ON t.target = s.target AND t.level_unit = s.level_unit GROUP BY ALL")
def q_breakdown_strata(spark, sf_dir):
    return _strata(spark, sf_dir)[0]


@query(_STRATA + " SELECT target, level_unit, label, value FROM strata WHERE (target, level_unit) NOT IN (SELECT (target, level_unit) FROM totals)")
def q_strata_without_total(spark, sf_dir):
    return _strata(spark, sf_dir)[1]


@query("""SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE round(value)::INTEGER END AS n,
    CASE WHEN event_id % 11 = 0 THEN 'bad_number' WHEN abs(value - round(value)) > 1e-6 THEN 'fractional_count' END AS issue FROM events""")
def q_fractional_counts(spark, sf_dir):
    text = F.when(F.col("event_id") % 11 == 0, "n/a").otherwise(F.col("value").cast("string"))
    n, issue = scalars.whole_number(text)
    return views.table(spark, sf_dir, "events").select("event_id", n.alias("n"), issue.alias("issue"))


@query("SELECT o_orderkey, round(o_totalprice / 7.0 * 1e10) / 1e10 AS score FROM orders")
def q_scores(spark, sf_dir):
    return views.table(spark, sf_dir, "orders").select("o_orderkey", scalars.score(F.col("o_totalprice"), F.lit(7.0)).alias("score"))


@query("SELECT p_partkey, CASE WHEN p_size = 1 THEN 'cohort' WHEN p_partkey % 3 = 0 THEN 'proportion' ELSE 'ratio' END AS scoring FROM part")
def q_measure_scoring(spark, sf_dir):
    return views.table(spark, sf_dir, "part").select("p_partkey", scalars.scoring(F.col("p_size").cast("string"), F.when(F.col("p_partkey") % 3 == 0, 100).otherwise(1)).alias("scoring"))


# Organizations, text and JSON

_ORGS = """places AS (SELECT 'c' || c_custkey AS id, c_name AS name, 'o' || c_custkey % 300 AS managing_organization FROM customer),
orgs AS (SELECT 'o' || s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_name END AS name FROM supplier)"""


def _orgs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    places = views.table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("id"), F.col("c_name").alias("name"), F.concat(F.lit("o"), F.col("c_custkey") % 300).alias("managing_organization"))
    orgs = views.table(spark, sf_dir, "supplier").select(F.concat(F.lit("o"), "s_suppkey").alias("id"), F.when(F.col("s_suppkey") % 3 != 0, F.col("s_name")).alias("name"))
    return places, orgs


@query(f"WITH {_ORGS} SELECT p.id, p.managing_organization, o.name AS organization_name FROM places p LEFT JOIN orgs o ON o.id = p.managing_organization")
def q_location_org_join(spark, sf_dir):
    return reports.with_organizations(*_orgs(spark, sf_dir)).select("id", "managing_organization", F.col("_name").alias("organization_name"))


@query(f"WITH {_ORGS} SELECT id AS location_id FROM places WHERE managing_organization NOT IN (SELECT id FROM orgs)")
def q_org_missing(spark, sf_dir):
    return reports.organization_issues(*_orgs(spark, sf_dir)).where("kind = 'organization_missing'").select("location_id")


@query(f"WITH {_ORGS} SELECT p.id AS location_id FROM places p JOIN orgs o ON o.id = p.managing_organization WHERE o.name <> p.name")
def q_org_name_mismatch(spark, sf_dir):
    return reports.organization_issues(*_orgs(spark, sf_dir)).where("kind = 'organization_name_mismatch'").select("location_id")


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN coalesce(CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_brand END, p_type) ELSE p_type END AS code FROM part")
def q_identifier_promote(spark, sf_dir):
    item = [F.struct(F.lit("b").alias("system"), F.col("p_type").alias("value")), F.struct(F.when(F.col("p_size") % 2 == 0, "a").otherwise("c").alias("system"), F.when(F.col("p_size") % 4 != 0, F.col("p_brand")).alias("value"))]
    return views.table(spark, sf_dir, "part").select("p_partkey", scalars.in_preference(F.array(*item), ["a", "b"]).alias("code"))


@query("SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events")
def q_json_props(spark, sf_dir):
    return views.table(spark, sf_dir, "events").select("event_id", F.expr("try_variant_get(try_parse_json(props), '$.k', 'bigint')").alias("k"))


@query("SELECT page_id, nullif(split_part(url, '/', -1), '') AS last FROM pages")
def q_reference_strip(spark, sf_dir):
    return views.table(spark, sf_dir, "pages").select("page_id", scalars.reference_id(F.col("url")).alias("last"))


@query("SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name || '  ' || p_type || '!'), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM part")
def q_slugify_ascii(spark, sf_dir):
    return views.table(spark, sf_dir, "part").select("p_partkey", scalars.slugify(F.concat_ws("", "p_name", F.lit("  "), "p_type", F.lit("!"))).alias("slug"))


@query("SELECT p_partkey, array_to_string(list_filter(list_transform(string_split(replace(p_type, ' ', ' ; '), ';'), lambda x: trim(x)), lambda x: x <> ''), '|') AS aliases FROM part")
def q_alias_split(spark, sf_dir):
    return views.table(spark, sf_dir, "part").select("p_partkey", F.array_join(scalars.alias_list(F.replace(F.col("p_type"), F.lit(" "), F.lit(" ; "))), "|").alias("aliases"))


@query("""WITH r AS (SELECT s_suppkey, coalesce(n.n_nationkey, -1) AS nation, CASE WHEN s_suppkey % 7 = 0 THEN 'nowhere' ELSE lower(x.r_name) END AS a, CASE WHEN s_suppkey % 5 = 0 THEN 'nowhere' ELSE lower(n.n_name) END AS b, x.r_regionkey
    FROM supplier JOIN nation n ON s_nationkey = n.n_nationkey JOIN region x ON n.n_regionkey = x.r_regionkey)
SELECT s_suppkey, CASE WHEN a = 'nowhere' THEN NULL WHEN b = 'nowhere' THEN 'r' || r_regionkey ELSE 'n' || nation END AS parent FROM r""")
def q_name_chain_lookup(spark, sf_dir):
    from ..operators import bake

    s, n, r = (views.table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    rows = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    rows = rows.select("s_suppkey", F.when(F.col("s_suppkey") % 7 == 0, "Nowhere").otherwise(F.col("r_name")).alias("a"), F.when(F.col("s_suppkey") % 5 == 0, "Nowhere").otherwise(F.col("n_name")).alias("b"))
    admins = views.locs(spark, sf_dir).where("type = 'admin-unit'").select("id", "part_of", "name", F.array().cast("array<string>").alias("alias"))
    return bake.chain_lookup(rows, admins, ["a", "b"]).select("s_suppkey", "parent")


# Load planning


def _resources(spark, sf_dir) -> DataFrame:
    return views.locs(spark, sf_dir).select(F.lit("Location").alias("type"), "id", "part_of", (1000000000000 - F.col("seq")).alias("seq"))


_LOAD = f"""WITH RECURSIVE {views.CLOSURE}, placed AS (SELECT id, part_of, depth, (row_number() OVER (ORDER BY depth, -seq) - 1)::BIGINT AS place FROM tree), b AS (SELECT *, place // 100 AS bundle FROM placed)"""


@query(_LOAD + " SELECT id, depth, place FROM placed")
def q_load_order(spark, sf_dir):
    return bundles.load_order(_resources(spark, sf_dir)).select("id", "depth", "place")


@query(_LOAD + " SELECT bundle::BIGINT AS bundle, count(*)::BIGINT AS n, min(place) AS first FROM b GROUP BY bundle")
def q_bundle_plan(spark, sf_dir):
    return bundles.into_bundles(bundles.load_order(_resources(spark, sf_dir))).groupBy("bundle").agg(F.count("*").alias("n"), F.min("place").alias("first"))


@query(_LOAD + " SELECT DISTINCT b.bundle::BIGINT AS bundle, p.bundle::BIGINT AS needs FROM b JOIN b p ON b.part_of = p.id WHERE p.bundle < b.bundle")
def q_bundle_dependencies(spark, sf_dir):
    done = bundles.into_bundles(bundles.load_order(_resources(spark, sf_dir)))
    refs = done.where("part_of is not null").select("type", "id", F.lit("Location").alias("ref_type"), F.col("part_of").alias("ref_id"))
    return bundles.dependencies(done, refs)


# Rasters and polygons

_PIXELS = """px AS (SELECT (p_partkey % 360) - 179.5 AS lon, (p_partkey * 7 % 180) - 89.5 AS lat, (p_size - 3)::FLOAT AS v FROM part WHERE p_size <> 13),
rect AS (SELECT 'n' || n_nationkey AS id, n_nationkey * 14.0 - 180.0 AS xmin, n_nationkey * 5.0 - 80.0 AS ymin, n_nationkey * 14.0 - 150.0 AS xmax, n_nationkey * 5.0 - 35.0 AS ymax, n_regionkey FROM nation),
z AS (SELECT id, n_regionkey, sum(greatest(v, 0))::DOUBLE AS total, count(v)::BIGINT AS pixels FROM rect JOIN px ON lon >= xmin AND lon < xmax AND lat >= ymin AND lat < ymax GROUP BY ALL)"""


def _zones(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    p, k = views.table(spark, sf_dir, "part"), F.col("p_partkey")
    pixels = p.select((k % 360 - 179.5).alias("lon"), (k * 7 % 180 - 89.5).alias("lat"), F.when(F.col("p_size") == 13, -9999).otherwise(F.col("p_size") - 3).cast("float").alias("v"))
    n = F.col("n_nationkey")
    rect = views.table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), n).alias("id"), (n * 14.0 - 180).alias("xmin"), (n * 5.0 - 80).alias("ymin"), (n * 14.0 - 150).alias("xmax"), (n * 5.0 - 35).alias("ymax"))
    return raster.rectangle_sums(pixels, rect, 10.0, -9999), rect


@query(f"WITH {_PIXELS} SELECT id, total, pixels FROM z")
def q_zonal_sum(spark, sf_dir):
    return _zones(spark, sf_dir)[0]


@query(f"""WITH {_PIXELS}, leaf AS (SELECT r.id, r.n_regionkey, z.total, z.pixels FROM rect r LEFT JOIN z USING (id))
SELECT id, round(total)::BIGINT AS quantity, pixels, total IS NULL AS incomplete FROM leaf
UNION ALL SELECT 'r' || n_regionkey, sum(round(total)::BIGINT)::BIGINT, sum(pixels)::BIGINT, bool_or(total IS NULL) FROM leaf GROUP BY n_regionkey""")
def q_pixel_rollup(spark, sf_dir):
    sums, rect = _zones(spark, sf_dir)
    above = views.locs(spark, sf_dir).where("id like 'n%'").select("id", F.col("part_of").alias("ancestor"))
    return raster.roll_up(rect.select("id").join(sums, "id", "left"), above)


@query("""WITH leaf AS (SELECT 'n' || n_nationkey AS id, 'r' || n_regionkey AS part_of FROM nation)
SELECT part_of AS id, count(*)::BIGINT AS n FROM leaf GROUP BY part_of""")
def q_admin_ancestors(spark, sf_dir):
    rows = hierarchy.admin_ancestors(hierarchy.resolve(views.locs(spark, sf_dir)).where("type = 'admin-unit'"))
    return rows.where("distance = 0").groupBy(F.col("ancestor").alias("id")).agg(F.count("*").alias("n"))


from . import catalog_documents, catalog_places  # noqa: E402, F401  (they register their queries here)
