"""URL filters by temporal list joins, in DataFrame functions alone.

A list is a history of dated entries: (scope, pattern, at, listed), where scope is host, site (a host with
all hosts below it) or prefix (a host and the first segments of a path, with all paths below them), and listed
tells whether the pattern was put on the list or taken off it. Entries become validity intervals
[at, next entry of the pattern); equal dates are settled in favour of listing.

A capture meets every entry that can hold for it: its host, all suffixes of its host by labels and all
prefixes of its path by segments, of as many parts as any listed pattern has, are exploded, and one as-of join
finds the intervals that hold the fetch time. The finds and the captures themselves are then combined by
capture; of several active entries of a scope the earliest date counts.

The join is an equi-join on the key with a range condition, and inner: only finds leave it. A host that a third of all
captures share is one key that adaptive execution splits. The window that makes intervals sees each pattern's distinct
dates, which the calendar bounds, not its repeated entries. The numbers of parts that patterns have are
one broadcast row. Captures carry an id, a time and a URL; pages' contents are never read.

A prefix entry may end in a slash, which then stands for the paths below it alone; `host/` itself is only the URLs whose
first segment is empty. A null or malformed URL has no keys and a null time no active entry: neither is blocked. Entries with a
null pattern, time or flag are void. Repeated captures stay, empty lists block nothing, and other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCOPES = ("host", "site", "prefix")
HOST = r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:\[]+)"
PATH = r"^[a-z][a-z0-9+.\-]*://[^/?#]*(/[^/?#]*)"
PATHS = r"^[a-z][a-z0-9+.\-]*://[^/?#]*(/[^?#]*)"
SITE = r"((?:[^.]+\.){0,2}[^.]+)$"


def host_of(url: Column) -> Column:
    return F.nullif(F.regexp_extract(F.lower(url), HOST, 1), F.lit(""))


def site_of(host: Column) -> Column:
    return F.nullif(F.regexp_extract(host, SITE, 1), F.lit(""))


def prefix_of(url: Column) -> Column:
    return F.concat(host_of(url), F.nullif(F.regexp_extract(F.lower(url), PATH, 1), F.lit("")))


def intervals(entries: DataFrame) -> DataFrame:
    """(scope, pattern, since, until) of the times when a pattern is listed; until is null if it still is."""
    dated = entries.where("pattern is not null and at is not null and listed is not null").groupBy("scope", "pattern", "at").agg(F.max("listed").alias("listed"))
    later = F.lead("at").over(Window.partitionBy("scope", "pattern").orderBy("at"))
    return dated.withColumn("until", later).where("listed").select("scope", "pattern", F.col("at").alias("since"), "until")


def _parts(pattern: Column, sign: str) -> Column:
    return F.size(F.split(pattern, f"[{sign}]"))


def _keys(url: Column, lengths: dict[str, Column]) -> Column:
    """(scope, key) of a URL with a host: the host, its suffixes and the path's prefixes of the given numbers of parts."""
    host, path = host_of(url), F.concat(host_of(url), F.nullif(F.regexp_extract(F.lower(url), PATHS, 1), F.lit("")))

    def keys(scope: str, key: Column, holds: Column) -> Column:
        return F.when(holds, F.struct(F.lit(scope).alias("scope"), key.alias("key")))

    sites = F.transform(lengths["site"], lambda n: keys("site", F.call_function("substring_index", host, F.lit("."), -n), _parts(host, ".") >= n))
    paths = F.transform(lengths["prefix"], lambda n: keys("prefix", F.call_function("substring_index", path, F.lit("/"), n), _parts(path, "/") >= n))
    # `host/a/` holds for all that is below `host/a`
    below = F.transform(lengths["prefix"], lambda n: keys("prefix", F.concat(F.call_function("substring_index", path, F.lit("/"), n - 1), F.lit("/")), (n > 2) & (_parts(path, "/") >= n)))
    return F.array_distinct(F.array_compact(F.concat(F.array(keys("host", host, host.isNotNull())), sites, paths, below)))


def apply_lists(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """Per capture: id, host, and the date since which its host, site and prefix are listed at fetch time (null if not), and blocked."""
    rows = captures.select(captures[id_col].alias("_id"), captures[time_col].alias("_at"), captures[url_col].cast("string").alias("_url"))
    active = intervals(entries).where(F.col("scope").isin(*SCOPES)).withColumnRenamed("scope", "_scope")
    lengths = {s: F.collect_set(F.when(F.col("_scope") == s, _parts(F.col("pattern"), sign))).alias(f"_{s}") for s, sign in (("site", "."), ("prefix", "/"))}
    asked = rows.where(host_of(F.col("_url")).isNotNull() & F.col("_at").isNotNull()).crossJoin(F.broadcast(active.agg(*lengths.values())))
    asked = asked.select("_id", "_at", "_url", F.explode(_keys(F.col("_url"), {s: F.col(f"_{s}") for s in lengths})).alias("_k")).select("_id", "_at", "_url", "_k.*")
    met = (F.col("scope") == F.col("_scope")) & (F.col("key") == F.col("pattern")) & (F.col("since") <= F.col("_at")) & (F.col("until").isNull() | (F.col("_at") < F.col("until")))
    found = asked.join(active, met).select("_id", "_at", "_url", "scope", "since", F.lit(0).alias("n"))
    own = rows.select("_id", "_at", "_url", F.lit(None).cast("string").alias("scope"), F.lit(None).cast(entries.schema["at"].dataType).alias("since"), F.lit(1).alias("n"))
    since = {s: F.min(F.when(F.col("scope") == s, F.col("since"))).alias(f"{s}_since") for s in SCOPES}
    # captures alike in all three meet the same entries: they are combined and repeated again
    done = own.unionByName(found).groupBy("_id", "_at", "_url").agg(*since.values(), F.sum("n").cast("int").alias("_n"))
    done = done.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_n"))))
    return done.select(F.col("_id").alias(id_col), host_of(F.col("_url")).alias("host"), *[f"{s}_since" for s in SCOPES], F.coalesce(*[F.col(f"{s}_since") for s in SCOPES]).isNotNull().alias("blocked"))


def sample_history(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """A dated list over all hosts, sites and prefixes of the captures, fixed by the digits of each pattern's MD5:
    a third of the patterns are listed on a day of 2024, half of those leave the list later, and some of these return."""
    url = pages[url_col].cast("string")
    keys = pages.select(F.explode(F.array(*[F.struct(F.lit(s).alias("scope"), k.alias("pattern")) for s, k in (("host", host_of(url)), ("site", site_of(host_of(url))), ("prefix", prefix_of(url)))])).alias("k")).select("k.*")
    keys = keys.where("pattern is not null").distinct()

    def digits(first: int) -> Column:
        return F.conv(F.substring(F.md5(F.concat("scope", F.lit(" "), "pattern")), first, 3), 16, 10).cast("int")

    a, b, c = digits(1), digits(4), digits(7)
    on, off, back = a % 300, a % 300 + 1 + b % 60, a % 300 + 70 + c % 60
    dated = F.array(F.struct(on.alias("day"), F.lit(True).alias("listed")), F.struct(F.when(b % 2 == 0, off).alias("day"), F.lit(False).alias("listed")), F.struct(F.when((b % 2 == 0) & (c % 2 == 0), back).alias("day"), F.lit(True).alias("listed")))
    rows = keys.where(digits(10) % 3 == 0).select("scope", "pattern", F.explode(dated).alias("e"))
    return rows.select("scope", "pattern", F.date_add(F.lit("2024-01-01").cast("date"), F.col("e.day")).alias("at"), "e.listed")
