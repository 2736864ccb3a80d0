"""URL filter by a temporal list join.

A block list is a log of dated entries: from ``listed_at`` on a pattern is active or not. Entries
become validity intervals, and every capture is evaluated against the intervals that hold at its
fetch time: an as-of join. Intervals are cut at the borders of time buckets and captures join by
pattern and bucket, so the captures and the entries of a hot host are spread over the buckets of
its history instead of meeting in one window.

A pattern is a domain (it covers its subdomains) or a host with the first segments of a path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKET_SECONDS = 30 * 86400
_URL = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]*)?([^?#]*)"


def url_host(url: Column) -> Column:
    """The host in lower case; null where the text is not an absolute URL."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1))
    return F.when(host != "", host)


def url_patterns(url: Column, depth: Column | int) -> Column:
    """Every pattern that covers a URL: domain suffixes of two labels or more, path prefixes."""
    host = F.coalesce(url_host(url), F.lit(""))
    labels = F.split(host, r"\.")
    count = F.size(labels)
    domains = F.when(count >= 2, F.transform(F.sequence(F.lit(1), count - 1), lambda i: F.array_join(F.slice(labels, i, count), ".")))
    segments = F.filter(F.split(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2), "/"), lambda s: s != "")
    deep = F.least(F.size(segments), F.lit(depth))
    paths = F.when(deep >= 1, F.transform(F.sequence(F.lit(1), deep), lambda i: F.concat_ws("/", host, F.array_join(F.slice(segments, 1, i), "/"))))
    none = F.array().cast("array<string>")
    return F.when(host != "", F.array_distinct(F.concat(F.coalesce(domains, F.array(host)), F.coalesce(paths, none)))).otherwise(none)


def _bucket(at: Column) -> Column:
    return F.floor(F.unix_timestamp(at) / BUCKET_SECONDS).cast("long")


def _lower_host(pattern: Column) -> Column:
    """A pattern with its host in lower case; a path keeps its case, as in URLs."""
    host = F.substring_index(pattern, "/", 1)
    return F.concat(F.lower(host), F.substr(pattern, F.length(host) + 1))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(list_name, pattern, valid_from, valid_to) of the active stretches of each pattern.

    Of entries at one time the active one wins; ``valid_to`` is null while nothing follows.
    Entries without pattern or time are left out. The successor is looked for inside a time
    bucket first and then among the first entries of the pattern's later buckets, so a pattern
    with very many entries is split.
    """
    known = entries.where("pattern IS NOT NULL AND listed_at IS NOT NULL").select(
        F.coalesce("list_name", F.lit("")).alias("list_name"), _lower_host(F.col("pattern")).alias("pattern"),
        F.col("listed_at").cast("timestamp").alias("valid_from"), F.coalesce("active", F.lit(False)).alias("active"),
    )
    known = known.groupBy("list_name", "pattern", "valid_from").agg(F.max("active").alias("active")).withColumn("_at", _bucket(F.col("valid_from")))
    firsts = known.groupBy("list_name", "pattern", "_at").agg(F.min("valid_from").alias("_first"))
    later = firsts.withColumn("_later", F.lead("_first").over(W.partitionBy("list_name", "pattern").orderBy("_at"))).drop("_first")
    inside = W.partitionBy("list_name", "pattern", "_at").orderBy("valid_from")
    near = known.withColumn("_next", F.lead("valid_from").over(inside))
    both = near.join(later, ["list_name", "pattern", "_at"])
    return both.where("active").select("list_name", "pattern", "valid_from", F.coalesce("_next", "_later").alias("valid_to"))


def filter_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """One row per row of ``captures`` (page_id, url, fetched_at) with its verdict.

    ``page_id, host, fetched_at, blocked, lists, n_hits``: the sorted names of the lists with an
    active pattern that covers the URL when it was fetched, and the number of such patterns. A
    null or relative URL and a null fetch time hit nothing. Repeated captures each have a row.
    """
    intervals = validity_intervals(entries)
    depth = intervals.agg(F.max(F.size(F.split("pattern", "/")) - 1)).first()[0] or 0
    rows = captures.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("fetched_at").cast("timestamp").alias("fetched_at")
    ).withColumn("_row", F.xxhash64("page_id", "url", "fetched_at"))
    span = rows.agg(F.min(_bucket(F.col("fetched_at"))).alias("lo"), F.max(_bucket(F.col("fetched_at"))).alias("hi")).first()
    lo, hi = (span["lo"] or 0), (span["hi"] or 0)
    first = F.greatest(_bucket(F.col("valid_from")), F.lit(lo))
    last = F.least(F.coalesce(_bucket(F.col("valid_to")), F.lit(hi)), F.lit(hi))
    pieces = intervals.where(first <= last).withColumn("_at", F.explode(F.sequence(first, last)))
    keys = rows.where("fetched_at IS NOT NULL").select("_row", "fetched_at", _bucket(F.col("fetched_at")).alias("_at"), F.explode(url_patterns(F.col("url"), depth)).alias("pattern"))
    holds = (F.col("valid_from") <= F.col("fetched_at")) & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to")))
    hits = keys.distinct().join(pieces, ["pattern", "_at"]).where(holds)
    verdict = hits.groupBy("_row").agg(F.sort_array(F.collect_set("list_name")).alias("_lists"), F.count("*").alias("_n"))
    return rows.join(verdict, "_row", "left").select(
        "page_id", url_host(F.col("url")).alias("host"), "fetched_at", F.col("_n").isNotNull().alias("blocked"),
        F.coalesce(F.array_join("_lists", ","), F.lit("")).alias("lists"), F.coalesce("_n", F.lit(0)).alias("n_hits"),
    )


# ---- the registered query: captures and a list log derived from the pages ----------------------

START = "2023-01-01 00:00:00"
_LIST_DAYS, _FETCH_MINUTES, _CHANGES = 730, 2 * 365 * 1440, 4


def _draw(*parts: Column | str) -> Column:
    """A non-negative number from the MD5 of the joined parts; the same in any engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("long")


def _moved(minutes: Column) -> Column:
    return F.timestamp_seconds(F.unix_timestamp(F.lit(START).cast("timestamp")) + minutes * 60)


def page_captures(pages: DataFrame) -> DataFrame:
    """Pages as captures: the fetch time is spread over two years by a hash of the id."""
    return pages.select("page_id", "url", _moved(_draw(F.lit("fetch"), F.col("page_id").cast("string")) % _FETCH_MINUTES).alias("fetched_at"))


def page_list(pages: DataFrame) -> DataFrame:
    """A list log over the hosts and first path segments that occur in the pages.

    Two fifths of the patterns are listed; each changes its state four times, active first.
    """
    host = url_host(F.col("url"))
    segment = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)", 1)
    both = F.array(host, F.when(segment != "", F.concat_ws("/", host, segment)))
    patterns = pages.select(F.explode(both).alias("pattern")).where("pattern IS NOT NULL").distinct().where(_draw(F.lit("listed"), "pattern") % 5 < 2)
    changes = patterns.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(_CHANGES - 1))))
    day = _draw(F.lit("day"), "pattern", F.col("turn").cast("string")) % _LIST_DAYS
    name = F.when(_draw(F.lit("list"), "pattern") % 2 == 0, "adult").otherwise("malware")
    return changes.select(name.alias("list_name"), "pattern", _moved(day * 1440).alias("listed_at"), (F.col("turn") % 2 == 0).alias("active"))


ORACLE = """
WITH p AS (
  SELECT page_id, url,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)', 1) AS segment,
         TIMESTAMP '2023-01-01 00:00:00'
           + to_minutes(CAST(('0x' || substr(md5('fetch|' || page_id), 1, 8))::BIGINT % 1051200 AS BIGINT)) AS fetched_at
  FROM pages),
patterns AS (
  SELECT DISTINCT pattern FROM (
    SELECT host AS pattern FROM p WHERE host <> ''
    UNION ALL SELECT host || '/' || segment FROM p WHERE host <> '' AND segment <> '')
  WHERE ('0x' || substr(md5('listed|' || pattern), 1, 8))::BIGINT % 5 < 2),
log AS (
  SELECT pattern, CASE WHEN ('0x' || substr(md5('list|' || pattern), 1, 8))::BIGINT % 2 = 0 THEN 'adult' ELSE 'malware' END AS list_name,
         TIMESTAMP '2023-01-01 00:00:00'
           + to_days(CAST(('0x' || substr(md5('day|' || pattern || '|' || turn), 1, 8))::BIGINT % 730 AS INTEGER)) AS valid_from,
         max(turn % 2 = 0) AS active
  FROM patterns, (SELECT unnest([0, 1, 2, 3]) AS turn) GROUP BY ALL),
spans AS (
  SELECT *, lead(valid_from) OVER (PARTITION BY pattern ORDER BY valid_from) AS valid_to FROM log),
hits AS (
  SELECT p.page_id, s.list_name
  FROM p JOIN spans s ON s.active AND s.valid_from <= p.fetched_at AND (s.valid_to IS NULL OR p.fetched_at < s.valid_to)
   AND (s.pattern = p.host OR (contains(p.host, '.') AND contains(s.pattern, '.') AND NOT contains(s.pattern, '/') AND ends_with(p.host, '.' || s.pattern))
        OR (p.segment <> '' AND s.pattern = p.host || '/' || p.segment)))
SELECT p.page_id, nullif(p.host, '') AS host, p.fetched_at, count(h.list_name) > 0 AS blocked,
       coalesce(string_agg(DISTINCT h.list_name, ',' ORDER BY h.list_name), '') AS lists, count(h.list_name) AS n_hits
FROM p LEFT JOIN hits h USING (page_id) GROUP BY ALL
"""
