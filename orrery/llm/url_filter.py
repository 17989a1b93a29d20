"""Operator 6: URL filters as a temporal list join (DataFrame functions only).

Lists are logs of dated entries: (list, kind, value, action, at), where kind is
`domain` (the host and all its subdomains), `host` (that host alone) or `url`
(a URL prefix of whole path segments, with or without scheme), and action `add` or
`remove`.  Sorted by date, an entry's state holds until the next entry of the
same (list, kind, value): that is its validity interval [from, until).  A capture
is evaluated as of its fetch time: it is blocked by a list if any of its keys has
an active interval that holds the time.

A capture has a few keys (suffixes of its host, prefixes of its path of those
depths that url entries have, which one short job collects first).  Both sides
read a URL alike: host in lower case, no scheme, user, port, query, fragment or
empty segments.  Only distinct (key, fetch time) pairs meet
the intervals, so a host that holds a third of all captures is combined before
the shuffle, by time; the join is salted by time too, and intervals are repeated
once per salt.

Defined cases: NULL or unparsable URLs and NULL fetch times match nothing;
entries with a NULL field are ignored; entries of equal date: `remove` wins;
repeated captures give repeated rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SALTS = 16
#: scheme, authority (user, host, port) and path of a URL (fixed pattern)
URL = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)"


def host_of(url: Column) -> Column:
    return F.rtrim(F.lower(F.regexp_extract(url, URL, 1)), F.lit("."))


def _segments(url: Column) -> Column:
    return F.filter(F.split(F.regexp_extract(url, URL, 2), "/"), lambda s: s != "")


def _prefix(host: Column, segments: Column) -> Column:
    return F.array_join(F.concat(F.array(host), segments), "/")


def _keys(url: Column, depths: list[int]) -> Column:
    """array<string> of `kind|value` keys that can match the URL; depths: how many segments url entries have."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(F.lit("domain|"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    segments = _segments(url)
    used = F.filter(F.array(*map(F.lit, depths)).cast("array<int>"), lambda i: i <= F.size(segments))
    prefix = F.transform(used, lambda i: F.concat(F.lit("url|"), _prefix(host, F.slice(segments, F.lit(1), i))))
    return F.when(F.length(host) > 0, F.array_distinct(F.concat(suffix, F.array(F.concat(F.lit("host|"), host)), prefix))).otherwise(F.array().cast("array<string>"))


def _whole(entries: DataFrame) -> DataFrame:
    return entries.where(" AND ".join(f"{c} IS NOT NULL" for c in ("list", "kind", "value", "action", "at")))


def _entry_url(value: Column) -> Column:
    """The value of a url entry with a scheme, so that it reads like a capture's URL."""
    return F.concat(F.lit("any://"), F.regexp_replace(value, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//", ""))


def entry_depths(entries: DataFrame) -> list[int]:
    """The distinct numbers of path segments of url entries, in order."""
    found = _whole(entries).where("kind = 'url'").select(F.size(_segments(_entry_url(F.col("value")))).alias("depth")).distinct()
    return sorted(r.depth for r in found.collect())


def validity_intervals(entries: DataFrame) -> DataFrame:
    """list, key, from, until (NULL: still valid) of the periods in which an entry is on its list."""
    url = _entry_url(F.col("value"))
    value = F.when(F.col("kind") == "url", _prefix(host_of(url), _segments(url))).otherwise(F.rtrim(F.lower("value"), F.lit("/.")))
    e = _whole(entries).select("list", F.concat_ws("|", F.col("kind"), value).alias("key"), "action", "at")
    day = e.groupBy("list", "key", "at").agg(F.max(F.when(F.col("action") == "remove", 1).otherwise(0)).alias("gone"))
    order = Window.partitionBy("list", "key").orderBy("at")
    return day.withColumn("until", F.lead("at").over(order)).where("gone = 0").select("list", "key", F.col("at").alias("from"), "until")


def temporal_url_filter(captures: DataFrame, entries: DataFrame, salts: int = SALTS) -> DataFrame:
    """page_id, url, fetched, lists (sorted names of the lists that block it), blocked for every row of captures."""
    c = captures.select("page_id", "url", "fetched")
    keyed = c.withColumn("keys", F.when(F.col("fetched").isNotNull(), _keys(F.coalesce("url", F.lit("")), entry_depths(entries))).otherwise(F.array().cast("array<string>")))
    asked = keyed.select("url", "fetched", F.explode("keys").alias("key")).select("key", "fetched").distinct().withColumn("salt", F.pmod(F.xxhash64("fetched"), F.lit(salts)))
    spread = validity_intervals(entries).withColumn("salt", F.explode(F.expr(f"sequence(0L, {salts - 1}L)")))
    active = asked.join(spread, ["key", "salt"]).where("fetched >= `from` AND (until IS NULL OR fetched < until)").groupBy("key", "fetched").agg(F.sort_array(F.collect_set("list")).alias("lists"))
    # back to captures: URLs repeat less than hosts, and one row per (url, time) is enough
    urls = keyed.select("url", "fetched", "keys").where(F.size("keys") > 0).distinct().select("url", "fetched", F.explode("keys").alias("key"))
    hit = urls.join(active, ["key", "fetched"]).groupBy("url", "fetched").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("lists")))).alias("lists"))
    out = c.join(hit, ["url", "fetched"], "left")
    none = F.array().cast("array<string>")
    return out.select("page_id", "url", "fetched", F.coalesce("lists", none).alias("lists"), (F.size(F.coalesce("lists", none)) > 0).alias("blocked"))


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages as captures: the tables hold no fetch time, so a page's day is its number in a year of 360 days."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 7, F.lit(360)).cast("int"))
    return pages.select("page_id", "url", day.alias("fetched"))


def entries_of(pages: DataFrame) -> DataFrame:
    """A dated list made from the pages' own hosts: for every host whose name has an odd number of letters an entry
    is added on a day given by its length and removed 120 days later; parent domains come back later; every
    seventh page's URL is listed for good."""
    host = host_of(F.col("url"))
    hosts = pages.select(host.alias("h")).where("h <> ''").distinct().withColumn("n", F.length("h"))
    start = F.lit("2024-01-01").cast("date")
    day = F.date_add(start, F.pmod(F.col("n") * 11, F.lit(200)).cast("int"))
    odd = hosts.where("n % 2 = 1")
    parent = F.regexp_replace("h", r"^[^.]*\.", "")
    parts = [
        odd.select(F.lit("ads").alias("list"), F.lit("host").alias("kind"), F.col("h").alias("value"), F.lit("add").alias("action"), day.alias("at")),
        odd.select(F.lit("ads"), F.lit("host"), F.col("h"), F.lit("remove"), F.date_add(day, 120)),
        hosts.where("n % 5 = 0 AND size(split(h, '[.]')) > 3").select(F.lit("malware"), F.lit("domain"), parent, F.lit("add"), F.date_add(start, 180)),
        pages.where("page_id % 7 = 0").where(host != "").select(F.lit("spam"), F.lit("url"), F.regexp_extract("url", r"://([^?#]*)", 1), F.lit("add"), F.date_add(start, 90)),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.distinct()


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = temporal_url_filter(captures_of(pages), entries_of(pages))
    return got.select("page_id", "url", "fetched", F.array_join("lists", ",").alias("lists"), "blocked")


ORACLE_SQL = r"""
WITH p AS (
  SELECT page_id, url, (DATE '2024-01-01' + ((page_id * 7) % 360)::INTEGER) AS fetched,
    rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '.') AS host,
    rtrim(regexp_extract(url, '://([^?#]*)', 1), '/') AS path FROM pages
), h AS (
  SELECT DISTINCT host AS h, length(host) AS n FROM p WHERE host <> ''
), a AS (
  SELECT h, DATE '2024-01-01' + ((n * 11) % 200)::INTEGER AS d FROM h WHERE n % 2 = 1
), m AS (
  SELECT DISTINCT regexp_replace(h, '^[^.]*\.', '') AS v FROM h WHERE n % 5 = 0 AND len(string_split(h, '.')) > 3
), u AS (
  SELECT DISTINCT path AS v FROM p WHERE page_id % 7 = 0 AND host <> ''
), l AS (
  SELECT page_id, 'ads' AS list FROM p JOIN a ON a.h = p.host AND fetched >= d AND fetched < d + 120
  UNION SELECT page_id, 'malware' FROM p JOIN m ON (host = v OR ends_with(host, '.' || v)) AND fetched >= DATE '2024-01-01' + 180
  UNION SELECT page_id, 'spam' FROM p JOIN u ON (path = v OR starts_with(path, v || '/')) AND fetched >= DATE '2024-01-01' + 90
), g AS (
  SELECT page_id, string_agg(list, ',' ORDER BY list) AS lists FROM l GROUP BY page_id
)
SELECT page_id, url, fetched, coalesce(lists, '') AS lists, lists IS NOT NULL AS blocked FROM p LEFT JOIN g USING (page_id)
"""
