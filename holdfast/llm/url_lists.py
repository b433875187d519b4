"""URL filter by lists that change over time: a temporal join, in DataFrame functions only.

Method. A list is a log of dated entries (list, pattern, action, dated): ``add`` puts a pattern on the list, ``remove`` takes it
off. The log becomes validity intervals [valid_from, valid_to) per list and pattern. A capture is held against the entries that
were active when it was fetched: each URL gives the keys that a pattern can name (its host, the parent domains, and the host with
each leading part of the path), keys and patterns are joined on equality with the fetch time inside the interval, and the
longest pattern decides; between lists of equal patterns the allow list does.

Captures are reduced to distinct (url, time) before the join and joined back after it, so a host with a third of all captures
costs its distinct pairs only; both joins are on equal keys, which Spark splits where one is large. Nothing is broadcast by hint.

Defined results: a null or malformed URL, or a null time, matches nothing and is not blocked. Entries with a null field or another
action are no entries; of several on one day for one pattern, ``remove`` counts. Repeated captures give repeated rows. All
columns of the captures are kept; they must not be called host, pattern, list, category, n_active or blocked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"


def host_of(url: Column) -> Column:
    """Host in lower case, without user, port and a leading www."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)
    return F.regexp_replace(host, r"^www\.", "")


def segments_of(url: Column) -> Column:
    path = F.regexp_extract(url, r"^[a-zA-Z][^:]*://[^/?#]*([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda x: x != "")


def keys_of(host: Column, segments: Column) -> Column:
    """Every pattern that could name a URL: host, parent domains of two labels or more, host with parts of the path."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    domains = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), n - 1)), lambda i: F.concat_ws(".", F.slice(labels, i, n)))
    paths = F.when(
        F.size(segments) > 0,
        F.transform(F.sequence(F.lit(1), F.size(segments)), lambda i: F.concat(host, F.lit("/"), F.concat_ws("/", F.slice(segments, F.lit(1), i)))),
    ).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(domains, paths))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, pattern, category, valid_from, valid_to) from dated entries; an open interval ends in null."""
    daily = (
        entries.where(F.col("action").isin("add", "remove"))
        .where("list IS NOT NULL AND pattern IS NOT NULL AND dated IS NOT NULL")
        .groupBy("list", "pattern", "dated")
        .agg(F.max("action").alias("action"), F.max("category").alias("category"))
    )
    log = Window.partitionBy("list", "pattern").orderBy("dated")
    turns = daily.withColumn("was", F.lag("action").over(log)).where("action = 'add' AND (was IS NULL OR was = 'remove') OR action = 'remove' AND was = 'add'")
    return (
        turns.withColumn("valid_to", F.lead("dated").over(log))
        .where("action = 'add'")
        .select("list", "pattern", "category", F.col("dated").alias("valid_from"), "valid_to")
    )


def judged(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """``captures`` with host, the deciding pattern, list and category, the number of active patterns, and ``blocked``."""
    asked = (
        captures.select(F.col(url).alias("a_url"), F.col(fetched).alias("a_time"))
        .where("a_url IS NOT NULL AND a_time IS NOT NULL")
        .distinct()
        .withColumn("a_host", host_of(F.col("a_url")))
        .where("a_host <> ''")
    )
    keyed = asked.select("a_url", "a_time", F.explode(keys_of(F.col("a_host"), segments_of(F.col("a_url")))).alias("a_key"))
    active = keyed.join(
        intervals(entries),
        (F.col("a_key") == F.col("pattern")) & (F.col("valid_from") <= F.col("a_time")) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("a_time"))),
    )
    rule = F.struct(F.char_length("pattern").alias("size"), (F.col("list") == ALLOW).alias("allows"), "pattern", "list", "category")
    verdicts = active.groupBy("a_url", "a_time").agg(F.max(rule).alias("rule"), F.count("*").alias("n_active"))
    joined = captures.join(verdicts, (F.col(url) == F.col("a_url")) & (F.col(fetched) == F.col("a_time")), "left")
    return joined.select(
        *[captures[c] for c in captures.columns],
        F.coalesce(host_of(captures[url]), F.lit("")).alias("host"),
        F.col("rule.pattern").alias("pattern"),
        F.col("rule.list").alias("list"),
        F.col("rule.category").alias("category"),
        F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
        F.coalesce(F.col("rule.list") == BLOCK, F.lit(False)).alias("blocked"),
    )


# --- captures and lists derived from ``pages``, which has no times and no lists of its own ----------------------------


def captures_of(pages: DataFrame) -> DataFrame:
    """Fetch day of a page, from its id."""
    day = F.pmod(F.col("page_id") * 7919, F.lit(366)).cast("int")
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), day).alias("fetched"))


def entries_of(pages: DataFrame) -> DataFrame:
    """A log of block and allow entries over the hosts, parent domains and path parts that occur in ``pages``; a number
    taken from the MD5 of the pattern decides on list, days and category."""
    url = pages.select("url").distinct().withColumn("h", host_of(F.col("url"))).where("h <> ''")
    patterns = url.select(F.explode(keys_of(F.col("h"), segments_of(F.col("url")))).alias("pattern")).distinct()
    v = F.conv(F.substring(F.md5("pattern"), 1, 6), 16, 10).cast("long")
    day = F.pmod(F.col("v"), F.lit(366)).cast("int")
    third = F.pmod(F.floor(F.col("v") / 3), F.lit(3))
    kind = F.when(third == 0, "spam").when(third == 1, "malware").otherwise("adult")

    def entry(when: Column, list_name: str, action: str, after: Column, category: Column) -> Column:
        dated = F.date_add(F.lit("2024-01-01").cast("date"), after.cast("int"))
        return F.when(when, F.struct(F.lit(list_name).alias("list"), F.lit(action).alias("action"), dated.alias("dated"), category.alias("category")))

    blocked = F.col("v") % 3 == 0
    log = F.array(
        entry(blocked, BLOCK, "add", day, kind),
        entry(blocked & (F.col("v") % 2 == 0), BLOCK, "remove", day + F.col("v") % 90 + 1, kind),
        entry(blocked & (F.col("v") % 5 == 0), BLOCK, "add", day + 120 + F.col("v") % 30, kind),
        entry(F.col("v") % 7 == 0, ALLOW, "add", F.pmod(F.floor(F.col("v") / 7), F.lit(366)), F.lit("reviewed")),
    )
    return patterns.withColumn("v", v).select("pattern", F.explode(F.array_compact(log)).alias("e")).select("e.list", "pattern", "e.action", "e.dated", "e.category")


ORACLE = r"""
WITH urls AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST((page_id * 7919) % 366 AS INTEGER) AS fetched,
         regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)', 1), '^www\.', '') AS host,
         list_filter(string_split(regexp_extract(url, '^[a-zA-Z][^:]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS segs
  FROM pages),
keyed AS (
  SELECT DISTINCT url, fetched, unnest(list_concat(
           list_transform(range(1, greatest(2, len(string_split(host, '.')))), lambda i: array_to_string(string_split(host, '.')[i:], '.')),
           list_transform(range(1, len(segs) + 1), lambda i: host || '/' || array_to_string(segs[1:i], '/')))) AS pattern
  FROM urls WHERE host <> ''),
patterns AS (SELECT DISTINCT pattern, CAST('0x' || substr(md5(pattern), 1, 6) AS BIGINT) AS v FROM keyed),
marked AS (SELECT *, CASE (v // 3) % 3 WHEN 0 THEN 'spam' WHEN 1 THEN 'malware' ELSE 'adult' END AS kind FROM patterns),
entries AS (
  SELECT 'block' AS list, pattern, 'add' AS action, v % 366 AS day, kind AS category FROM marked WHERE v % 3 = 0
  UNION ALL SELECT 'block', pattern, 'remove', v % 366 + v % 90 + 1, kind FROM marked WHERE v % 3 = 0 AND v % 2 = 0
  UNION ALL SELECT 'block', pattern, 'add', v % 366 + 120 + v % 30, kind FROM marked WHERE v % 3 = 0 AND v % 5 = 0
  UNION ALL SELECT 'allow', pattern, 'add', (v // 7) % 366, 'reviewed' FROM marked WHERE v % 7 = 0),
active AS (
  SELECT k.url, k.fetched, k.pattern, e.list, arg_max(e.action, e.day * 2 + CASE e.action WHEN 'remove' THEN 1 ELSE 0 END) AS last_action,
         max(e.category) AS category
  FROM keyed k JOIN entries e ON e.pattern = k.pattern AND DATE '2024-01-01' + CAST(e.day AS INTEGER) <= k.fetched
  GROUP BY ALL),
best AS (
  SELECT *, row_number() OVER (PARTITION BY url, fetched ORDER BY length(pattern) DESC, list = 'allow' DESC, pattern DESC) AS r,
         count(*) OVER (PARTITION BY url, fetched) AS n
  FROM active WHERE last_action = 'add')
SELECT u.page_id, u.url, u.fetched, u.host, b.pattern, b.list, b.category, coalesce(b.n, 0) AS n_active, coalesce(b.list = 'block', FALSE) AS blocked
FROM urls u LEFT JOIN best b ON b.url = u.url AND b.fetched = u.fetched AND b.r = 1
"""
