"""URL filters: a temporal join of captures with dated block lists.

A list is a log of dated changes (``add`` or ``remove`` of a key).  Changes
become validity intervals ``[valid_from, valid_to)``, and every capture is
joined as of its fetch time with the intervals of its keys: the host, each
parent domain of two labels or more, and host plus first path segment.

Everything is native.  The join is an equi-join on the key, so a host that
holds a third of all captures is split by the adaptive skew join; the verdict
is a partially aggregated group-by.

Edge cases: user information, port, brackets and final dots belong to no key; a
URL without a scheme (``//host/path``) counts; numeric addresses have no parent
domains; very long URLs are read as a whole; columns other than id, URL and time
are not read, whatever their names; a NULL or unparsable URL has no key and is kept; a NULL fetch time
matches nothing; changes with NULL key, time or list are ignored; of several
changes of one key at one time ``remove`` wins; repeated changes count once;
repeated captures (same id, URL and time) give one row with ``n_captures``;
empty inputs give empty results or no matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


#: Scheme (or none: relative to a scheme), user information, and in group 1 the host.
AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#]*@)?(\[[^\]/?#]*\]?|[^/?#:]*)"
SEGMENT = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]+/([^/?#]+)"
#: Hosts without parent domains: numeric addresses.
ADDRESS = r"^(\d+\.){3}\d+$|:"


def host_of(url: Column) -> Column:
    """Lower-case host without user information, port, brackets and final dots, or NULL."""
    host = F.lower(F.rtrim(F.btrim(F.regexp_extract(url, AUTHORITY, 1), F.lit("[]")), F.lit(".")))
    return F.when(F.length(host) > 0, host)


def keys_of(url: Column) -> Column:
    """Array of list keys of a URL, empty without a host."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    parents = F.when(host.rlike(ADDRESS), F.array(host)).otherwise(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    segment = F.regexp_extract(url, SEGMENT, 1)
    with_path = F.when(F.length(segment) > 0, F.array(F.concat(host, F.lit("/"), segment))).otherwise(
        F.array().cast("array<string>"))
    return F.when(host.isNull(), F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.concat(parents, with_path)))


def intervals(changes: DataFrame) -> DataFrame:
    """(list, key, valid_from, valid_to) of dated changes (list, key, action, changed_at)."""
    one = (changes.where(F.col("action").isin("add", "remove")).dropna(subset=["list", "key", "changed_at"])
           .groupBy("list", "key", "changed_at").agg(F.max("action").alias("action")))
    order = W.partitionBy("list", "key").orderBy("changed_at")
    return (one.withColumn("valid_to", F.lead("changed_at").over(order)).where(F.col("action") == "add")
            .select("list", "key", F.col("changed_at").alias("valid_from"), "valid_to"))


def url_filter(captures: DataFrame, changes: DataFrame, id_column: str = "page_id",
               time_column: str = "fetched_at") -> DataFrame:
    """One row per capture: id, url, time, n_captures, matched lists and keys, blocked.

    ``n_entries`` counts the list entries active at the fetch time.
    """
    c = (captures.select(F.col(id_column).alias(id_column), "url", F.col(time_column).alias(time_column))
         .groupBy(id_column, "url", time_column).agg(F.count(F.lit(1)).alias("n_captures")))
    c = c.withColumn("key", F.explode_outer(keys_of(F.col("url"))))
    e = intervals(changes).withColumnRenamed("key", "_key")
    hit = ((F.col("key") == F.col("_key")) & (F.col(time_column) >= F.col("valid_from"))
           & (F.col("valid_to").isNull() | (F.col(time_column) < F.col("valid_to"))))
    return (c.join(e, hit, "left").groupBy(id_column, "url", time_column)
            .agg(F.max("n_captures").alias("n_captures"), F.count("list").alias("n_entries"),
                 F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"),
                 F.array_join(F.array_sort(F.collect_set(F.when(F.col("list").isNotNull(), F.col("key")))),
                              ",").alias("keys"))
            .withColumn("blocked", F.col("n_entries") > 0))


def page_captures(pages: DataFrame) -> DataFrame:
    """Captures of the ``pages`` table: it has no fetch time, so the day follows from the id."""
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"),
                                                     (F.col("page_id") % 360).cast("int")).alias("fetched_at"))


LISTS = ("adult", "malware", "spam")


def page_changes(pages: DataFrame) -> DataFrame:
    """Dated changes derived from the keys seen in ``pages``.

    The digest of list and key decides whether a key is listed (one in four),
    the day it is added, removed and added again.
    """
    keys = pages.select(F.explode(keys_of(F.col("url"))).alias("key")).distinct()
    digest = F.conv(F.substring(F.md5(F.concat("list", F.lit(":"), "key")), 1, 7), 16, 10).cast("int")
    listed = (keys.withColumn("list", F.explode(F.array(*[F.lit(x) for x in LISTS])))
              .withColumn("d", digest).where(F.col("d") % 4 == 0))

    def day(n: Column) -> Column:
        return F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int"))

    first = (F.col("d") / 4).cast("int") % 180
    steps = F.array(*[F.struct(F.lit(a).alias("action"), day(first + k).alias("changed_at"))
                      for a, k in (("add", 0), ("remove", 90), ("add", 150))])
    return listed.select("list", "key", F.explode(steps).alias("s")).select("list", "key", "s.action", "s.changed_at")


#: DuckDB SQL of the query over ``pages``.
ORACLE = r"""
WITH cut AS (
  SELECT DISTINCT page_id, url, CASE WHEN regexp_matches(url, '^([A-Za-z][A-Za-z0-9+.-]*:)?//')
                                     THEN substr(url, instr(url, '//') + 2) END AS rest
  FROM pages),
named AS (SELECT *, list_last(string_split(regexp_extract(rest, '^[^/?#]*'), '@')) AS place FROM cut),
parts AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % 360 AS INTEGER) AS fetched_at,
         NULLIF(lower(rtrim(CASE WHEN starts_with(place, '[') THEN split_part(substr(place, 2), ']', 1)
                                 ELSE split_part(place, ':', 1) END, '.')), '') AS host,
         NULLIF(regexp_extract(split_part(split_part(rest, '?', 1), '#', 1), '^[^/]+/([^/]+)', 1), '') AS segment
  FROM named),
counted AS (SELECT page_id, url, count(*) AS n_captures FROM pages GROUP BY ALL),
keyed AS (
  SELECT page_id, url, fetched_at, unnest(list_distinct(list_concat(
    [array_to_string(string_split(host, '.')[i:], '.')
     FOR i IN range(1, CASE WHEN host LIKE '%:%' OR regexp_full_match(host, '([0-9]+[.]){3}[0-9]+') THEN 2
                            ELSE greatest(len(string_split(host, '.')), 2) END)],
    CASE WHEN segment IS NULL THEN [] ELSE [host || '/' || segment] END))) AS key
  FROM parts WHERE host IS NOT NULL),
listed AS (
  SELECT list, key, CAST('0x' || substr(md5(list || ':' || key), 1, 7) AS INTEGER) AS d
  FROM (SELECT DISTINCT key FROM keyed), (SELECT unnest(['adult', 'malware', 'spam']) AS list)),
dated AS (SELECT list, key, (d // 4) % 180 AS f FROM listed WHERE d % 4 = 0),
valid AS (
  SELECT list, key, DATE '2024-01-01' + CAST(f AS INTEGER) AS a, DATE '2024-01-01' + CAST(f + 90 AS INTEGER) AS b FROM dated
  UNION ALL SELECT list, key, DATE '2024-01-01' + CAST(f + 150 AS INTEGER), DATE '9999-01-01' FROM dated),
hits AS (
  SELECT page_id, url, fetched_at, list, key FROM keyed JOIN valid USING (key)
  WHERE fetched_at >= a AND fetched_at < b)
SELECT p.page_id, p.url, p.fetched_at, any_value(c.n_captures) AS n_captures, count(h.list) AS n_entries,
       coalesce(string_agg(DISTINCT h.list, ',' ORDER BY h.list), '') AS lists,
       coalesce(string_agg(DISTINCT h.key, ',' ORDER BY h.key), '') AS keys,
       count(h.list) > 0 AS blocked
FROM parts p JOIN counted c ON c.page_id IS NOT DISTINCT FROM p.page_id AND c.url IS NOT DISTINCT FROM p.url
LEFT JOIN hits h ON h.page_id IS NOT DISTINCT FROM p.page_id AND h.url IS NOT DISTINCT FROM p.url
GROUP BY p.page_id, p.url, p.fetched_at
"""
