"""A place registry and its facts, made from the driver's tables in the same way in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _place(key, a: int, b: int) -> list:
    return [(key * a % 3600001 / 1e4 - 180.0).alias("lon"), (key * b % 1700001 / 1e4 - 85.0).alias("lat")]


def locs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, part_of, type, pcode, name, lon, lat, seq: regions and nations as administrative units, suppliers and customers below nations."""
    text, nothing = F.lit(None).cast("string"), [F.lit(None).cast("double").alias(c) for c in ("lon", "lat")]

    def name(prefix: str, key) -> object:
        return F.concat(F.lit(prefix), key.cast("string"))

    k = F.col("r_regionkey")
    region = table(spark, sf_dir, "region").select(name("r", k).alias("id"), text.alias("part_of"), F.lit("admin-unit").alias("type"), name("R", k).alias("pcode"), F.col("r_name").alias("name"), *nothing, k.cast("long").alias("seq"))
    k = F.col("n_nationkey")
    nation = table(spark, sf_dir, "nation").select(name("n", k), name("r", F.col("n_regionkey")), F.lit("admin-unit"), name("N", k % 20), "n_name", *nothing, (k + 1000).cast("long"))
    k = F.col("s_suppkey")
    supplier = table(spark, sf_dir, "supplier").select(name("s", k), name("n", F.col("s_nationkey")), F.lit("facility"), text, "s_name", *_place(k, 7919, 104729), k + 100000)
    k = F.col("c_custkey")
    below = F.when(k % 97 == 0, "n999").otherwise(name("n", F.col("c_nationkey")))
    customer = table(spark, sf_dir, "customer").select(name("c", k), below, F.when(k % 3 == 0, "settlement").otherwise("facility"), text, "c_name", *_place(k, 15485863, 32452843), k + 1000000000)
    return region.union(nation).union(supplier).union(customer)


LOCS = """
locs AS (
  SELECT 'r' || r_regionkey AS id, NULL::VARCHAR AS part_of, 'admin-unit' AS type, 'R' || r_regionkey AS pcode, r_name AS name, NULL::DOUBLE AS lon, NULL::DOUBLE AS lat, r_regionkey::BIGINT AS seq FROM region
  UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, 'admin-unit', 'N' || (n_nationkey % 20), n_name, NULL, NULL, n_nationkey + 1000 FROM nation
  UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey, 'facility', NULL, s_name, s_suppkey * 7919 % 3600001 / 1e4 - 180.0, s_suppkey * 104729 % 1700001 / 1e4 - 85.0, s_suppkey + 100000 FROM supplier
  UNION ALL SELECT 'c' || c_custkey, CASE WHEN c_custkey % 97 = 0 THEN 'n999' ELSE 'n' || c_nationkey END, CASE WHEN c_custkey % 3 = 0 THEN 'settlement' ELSE 'facility' END, NULL, c_name,
    c_custkey * 15485863 % 3600001 / 1e4 - 180.0, c_custkey * 32452843 % 1700001 / 1e4 - 85.0, c_custkey + 1000000000 FROM customer)"""

#: Ancestors, nearest first, of every place: (id, anc, dist).
CLOSURE = LOCS + """,
up AS (SELECT l.id, p.id AS parent FROM locs l LEFT JOIN locs p ON l.part_of = p.id),
closure AS (SELECT id, parent AS anc, 1 AS dist FROM up WHERE parent IS NOT NULL
            UNION ALL SELECT c.id, u.parent, c.dist + 1 FROM closure c JOIN up u ON u.id = c.anc WHERE u.parent IS NOT NULL AND c.dist < 40),
line AS (SELECT id, string_agg(anc, '/' ORDER BY dist DESC) AS anc, max(dist) AS depth FROM closure GROUP BY id),
tree AS (SELECT l.*, coalesce(line.anc, '') AS ancestors, coalesce(line.depth, 0)::INTEGER AS depth,
           coalesce(r.pcode, CASE WHEN l.type = 'admin-unit' AND l.id LIKE 'r%' THEN l.pcode END) AS root_code,
           CASE WHEN l.id LIKE 'r%' THEN l.name ELSE r.name END AS admin0_name,
           CASE WHEN l.id LIKE 'n%' THEN l.name ELSE n.name END AS admin1_name
         FROM locs l LEFT JOIN line USING (id)
         LEFT JOIN (SELECT c.id, a.pcode, a.name FROM closure c JOIN locs a ON a.id = c.anc WHERE a.id LIKE 'r%') r USING (id)
         LEFT JOIN (SELECT c.id, a.pcode, a.name FROM closure c JOIN locs a ON a.id = c.anc WHERE a.id LIKE 'n%') n USING (id))"""


def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a forest of chains of 50, with a cycle of the last two keys, a key that leads into it, and repeated ids."""
    k = F.col("p_partkey")
    part = table(spark, sf_dir, "part")
    top = part.agg(F.max("p_partkey").alias("_m"))
    up = F.when(k == F.col("_m"), k - 1).when(k == F.col("_m") - 1, k + 1).when(k == F.col("_m") - 2, k + 1).when(k % 50 != 1, k - 1)
    rows = part.crossJoin(F.broadcast(top)).select(k.cast("string").alias("id"), up.cast("string").alias("part_of"), F.lit("facility").alias("type"), F.lit(None).cast("string").alias("pcode"), F.col("p_name").alias("name"), k.alias("seq"))  # one row beside the parts
    return rows.union(rows.where("seq % 100 = 7").withColumns({"part_of": F.lit("1"), "seq": F.col("seq") + 1000000000}))


CHAIN = """
chain0 AS (SELECT p_partkey AS k, (SELECT max(p_partkey) FROM part) AS m FROM part),
chain1 AS (SELECT k, CASE WHEN k = m THEN k - 1 WHEN k IN (m - 1, m - 2) THEN k + 1 WHEN k % 50 <> 1 THEN k - 1 END AS part_of FROM chain0),
parents AS (SELECT c.k, p.k AS up FROM chain1 c LEFT JOIN chain1 p ON c.part_of = p.k),
down AS (SELECT k, 0 AS depth FROM parents WHERE up IS NULL UNION ALL SELECT p.k, d.depth + 1 FROM down d JOIN parents p ON p.up = d.k),
walk AS (SELECT k AS start, up AS here, 1 AS n FROM parents WHERE k NOT IN (SELECT k FROM down)
         UNION ALL SELECT start, p.up, n + 1 FROM walk JOIN parents p ON p.k = walk.here WHERE n < 12),
ring AS (SELECT DISTINCT start AS k FROM walk WHERE here = start)"""


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as data values: element, unit, option, attribute, period (a day), value in whole hundredths."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_type").alias("element"), F.concat(F.lit("s"), (F.col("user_id") % 10 + 1).cast("string")).alias("unit"), (F.col("event_id") % 4).cast("string").alias("option"),
        F.lit("x").alias("attribute"), F.date_format("ts", "yyyyMMdd").alias("period"), F.floor(F.col("value") * 100).cast("long").alias("value"),
    )


FACTS = """
facts AS (SELECT event_type AS element, 's' || (user_id % 10 + 1) AS unit, (event_id % 4)::VARCHAR AS option, 'x' AS attribute,
          strftime(ts, '%Y%m%d') AS period, ts::DATE AS day, floor(value * 100)::BIGINT AS value FROM events)"""
