"""The hierarchy of places: chains of ancestors, depth, administrative levels, cycles.

Only ids that occur as a parent are looked up again and again, as deep as a place may lie, in one plan over one
table; in a registry they are few beside the facilities below them, which are attached by one join at the end. Chains
carry the ancestors' few attributes, so no later stage looks them up again. What is still open then lies too deep, on a
cycle or below one, and is told apart by pointer doubling among itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import folder, written

CHAIN = "array<struct<id:string,admin:boolean,name:string,pcode:string>>"
ADMIN, MAX_DEPTH, ADMIN_COLUMNS = "admin-unit", 12, 5


def first_of_each(records: DataFrame, key: str = "id", order: str = "seq") -> DataFrame:
    """The first record of each key in file order; combines on the map side."""
    rest = [c for c in records.columns if c not in (key, order)]
    return records.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(order, *rest), order).alias("r")).select(key, "r.*")


def duplicates(records: DataFrame, key: str = "id", order: str = "seq") -> DataFrame:
    """(id, seq) of the records after the first of their id. Only ids that occur twice are looked at in order."""
    twice = records.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(key)
    first = records.join(twice, key, "left_semi").groupBy(key).agg(F.min(order).alias("_first")).select(F.col(key).alias("_k"), "_first")
    return records.join(first, (F.col(key) == F.col("_k")) & (F.col(order) > F.col("_first"))).select(key, order)


def orphans(records: DataFrame) -> DataFrame:
    """Records, repeated ones too, whose parent is not among the ids."""
    named, known = _parents(records)
    gone = named.join(known, F.col("_up") == F.col("_id"), "left_anti")
    return records.join(gone, F.col("part_of") == F.col("_up"), "left_semi")


def _parents(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((_up) the distinct ids that records name as their parent, (_id) those of them that are records). They are few beside the records, which
    are then not shuffled by id."""
    named = records.where("part_of is not null").select(F.col("part_of").alias("_up")).distinct()
    return named, records.select(F.col("id").alias("_id")).join(named, F.col("_id") == F.col("_up"), "left_semi").distinct()


def resolve(records: DataFrame) -> DataFrame:
    """records: id, part_of, type, name, pcode, seq and more. Adds parent (null for roots and orphans), dropped
    (cycle, unreachable_ancestor, too_deep or null), chain (ancestors, nearest first: id, admin, name, pcode)."""
    path = folder(records.sparkSession)
    # ids that occur once, which are nearly all, need no look at their order
    twice = written(records.where("id is not null").groupBy("id").agg(F.count("*").alias("_n")).where("_n > 1").select("id"), f"{path}/twice")
    first = records.where("id is not null").join(twice, "id", "left_anti").unionByName(first_of_each(records.join(twice, "id", "left_semi")))
    known = written(_parents(first)[1], f"{path}/known")
    linked = written(first.join(known, F.col("part_of") == F.col("_id"), "left").withColumnRenamed("_id", "parent"), f"{path}/linked")
    inner = linked.join(known, F.col("id") == F.col("_id"), "left_semi")
    inner = written(inner.select("id", "parent", (F.col("type") == ADMIN).alias("admin"), "name", "pcode"), f"{path}/inner")
    own = inner.select(F.col("id").alias("_i"), F.struct("id", "admin", "name", "pcode").alias("_own"), F.col("parent").alias("_top"))
    state = inner.select("id", F.col("parent").alias("top"), F.array().cast(CHAIN).alias("chain"))
    for _ in range(MAX_DEPTH):  # one plan: each step looks up the next ancestor of those that have one
        state = state.join(own, _spread("top", "id") == F.col("_i"), "left")
        state = state.select("id", F.col("_top").alias("top"), F.when(F.col("_i").isNull(), F.col("chain")).otherwise(F.array_append("chain", F.col("_own"))).alias("chain"))
    state = written(state, f"{path}/chains")
    cyclic = _endless(state.where("top is not null").select("id", "top"), path) if state.where("top is not null").limit(1).count() else state.limit(0).select("id", F.lit("cycle").alias("fate"))
    above = state.join(own.drop("_top"), F.col("id") == F.col("_i")).join(cyclic, "id", "left")
    above = written(above.select(F.col("id").alias("_i"), F.array_prepend("chain", F.col("_own")).alias("chain"), F.col("fate").alias("_fate")), f"{path}/above")
    place = linked.join(above, _spread("parent", "id") == F.col("_i"), "left").drop("_i")
    if cyclic.limit(1).count():
        place = place.join(cyclic.select(F.col("id").alias("_i"), F.col("fate").alias("_own")), F.col("id") == F.col("_i"), "left").drop("_i")
    else:
        place = place.withColumn("_own", F.lit(None).cast("string"))
    dropped = F.when(F.col("parent").isNull(), None).when(F.col("_own").isNotNull(), F.col("_own")).when(F.col("_fate").isNotNull(), "unreachable_ancestor").when(F.size("chain") >= MAX_DEPTH, "too_deep")
    chain = F.coalesce("chain", F.array().cast(CHAIN))
    return written(place.select(*first.columns, "parent", dropped.alias("dropped"), chain.alias("chain")), f"{path}/resolved")


def _spread(pointer: str, key: str):
    """A pointer as a join key: where it is null, a text that no id equals and that spreads such rows over the tasks."""
    return F.coalesce(pointer, F.concat(F.lit("\0"), key))


def _endless(state: DataFrame, path: str) -> DataFrame:
    """(id, fate) of the nodes (id, top) with an open pointer from which no root is reached: cycle for members, else unreachable_ancestor.

    Pointers are doubled until a round changes neither the number of open ones nor that of their targets. From then
    on the step maps the targets onto themselves, so they are the cycles' members, and all others lead into them.
    """
    rest, k, last = written(state, f"{path}/open0"), 0, None
    while True:
        found = rest.agg(F.count("*").alias("n"), F.count_distinct("top").alias("targets")).first()
        if not found["n"] or tuple(found) == last:
            break
        last, k = tuple(found), k + 1
        # a target outside the rest has reached a root
        far = rest.select(F.col("id").alias("_i"), F.col("top").alias("_t"))
        rest = written(rest.join(far, F.col("top") == F.col("_i")).select("id", F.col("_t").alias("top")), f"{path}/open{k}")
    on = rest.select(F.col("top").alias("_m")).distinct()
    return rest.join(on, F.col("id") == F.col("_m"), "left").select("id", F.when(F.col("_m").isNotNull(), "cycle").otherwise("unreachable_ancestor").alias("fate"))


def with_levels(resolved: DataFrame) -> DataFrame:
    """Adds depth, ancestor_ids (root first), path, admin_level, admin0..4 names and codes, and first_pcode."""
    line = F.reverse("chain")
    self_ = F.struct("id", (F.coalesce(F.col("type"), F.lit("")) == ADMIN).alias("admin"), "name", "pcode")
    admins = F.filter(F.concat(line, F.array(self_)), lambda n: n["admin"])
    out = resolved.withColumns({"depth": F.size("chain"), "ancestor_ids": F.transform(line, lambda n: n["id"]), "_admins": admins})
    out = out.withColumn("path", F.concat(F.lit("/"), F.array_join(F.array_append("ancestor_ids", F.col("id")), "/")))
    level = F.when(F.col("type") == ADMIN, F.size("_admins") - 1)
    columns: dict[str, Column] = {"admin_level": level, "first_pcode": F.get("_admins", F.lit(0))["pcode"]}
    for k in range(ADMIN_COLUMNS):
        columns |= {f"admin{k}_name": F.get("_admins", F.lit(k))["name"], f"admin{k}_code": F.get("_admins", F.lit(k))["pcode"]}
    return out.withColumns(columns).drop("_admins")


def with_country(levels: DataFrame, country: str | None = None) -> DataFrame:
    """Adds tier (the level of an administrative unit, else site) and country (given, or the root unit's code, or unknown)."""
    own = F.lit(country) if country else F.coalesce("first_pcode", F.lit("unknown"))
    return levels.withColumns({"tier": F.coalesce(F.col("admin_level").cast("string"), F.lit("site")), "country": own})


def hierarchy_issues(records: DataFrame, resolved: DataFrame) -> DataFrame:
    """(kind, location_id, detail, seq) of everything the hierarchy reports."""

    def issue(rows: DataFrame, kind: Column, detail: Column) -> DataFrame:
        return rows.select(kind.alias("kind"), F.col("id").alias("location_id"), detail.cast("string").alias("detail"), "seq")

    found = issue(duplicates(records), F.lit("duplicate_id"), F.col("seq"))
    found = found.unionByName(issue(orphans(records), F.lit("orphan"), F.col("part_of")))
    found = found.unionByName(issue(resolved.where("dropped is not null"), F.col("dropped"), F.col("parent")))
    deep = resolved.where((F.col("type") == ADMIN) & (F.size("chain") >= ADMIN_COLUMNS) & F.col("dropped").isNull())
    beyond = with_levels(deep).where(F.col("admin_level") >= ADMIN_COLUMNS)
    return found.unionByName(issue(beyond, F.lit("admin_level_beyond_columns"), F.col("admin_level")))


def admin_ancestors(levels: DataFrame) -> DataFrame:
    """(id, ancestor, distance): administrative ancestors, the nearest first."""
    near = F.filter("chain", lambda n: n["admin"])
    return levels.select("id", F.posexplode(F.transform(near, lambda n: n["id"])).alias("distance", "ancestor"))


def depth_in_set(rows: DataFrame) -> DataFrame:
    """Adds depth, the number of ancestors of each row among the given rows alone (a parent outside the set makes a root), and dropped:
    cycle for rows on a cycle or below one. Chains may be of any length."""
    path = folder(rows.sparkSession)
    first = first_of_each(rows.select("id", "part_of", "seq"))
    linked = first.join(first.select(F.col("id").alias("parent")), F.col("part_of") == F.col("parent"), "left")
    inner = linked.join(linked.where("parent is not null").select(F.col("parent").alias("_p")).distinct(), F.col("id") == F.col("_p"), "left_semi")
    inner = written(inner.select("id", "parent"), f"{path}/inner")
    state = inner.select("id", F.col("parent").alias("top"), F.col("parent").isNotNull().cast("long").alias("depth"))
    own = inner.select(F.col("id").alias("_i"), F.col("parent").alias("_top"))
    for _ in range(MAX_DEPTH):
        state = state.join(own, _spread("top", "id") == F.col("_i"), "left").select("id", F.col("_top").alias("top"), (F.col("depth") + F.col("_top").isNotNull().cast("long")).alias("depth"))
    state, last, k = written(state, f"{path}/depth0"), None, 0
    while True:
        found = tuple(state.where("top is not null").agg(F.count("*"), F.count_distinct("top")).first())
        if not found[0] or found == last:
            break
        last, k = found, k + 1
        far = state.select(F.col("id").alias("_i"), F.col("top").alias("_t"), F.col("depth").alias("_d"))
        state = state.join(far, _spread("top", "id") == F.col("_i"), "left").select("id", F.col("_t").alias("top"), (F.col("depth") + F.coalesce("_d", F.lit(0))).alias("depth"))
        state = written(state, f"{path}/depth{k}")
    above = state.select(F.col("id").alias("_i"), F.col("depth").alias("_d"), F.col("top").isNotNull().alias("_open"))
    placed = linked.join(above, _spread("parent", "id") == F.col("_i"), "left")
    found = placed.select(F.col("id").alias("_k"), F.coalesce(F.col("_d") + 1, F.lit(0)).cast("int").alias("depth"), F.when(F.col("_open"), "cycle").alias("dropped"))
    return rows.join(found, F.col("id") == F.col("_k")).drop("_k")
