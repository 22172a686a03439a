"""URL filters: dated list entries as validity intervals, joined with captures as of their fetch time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import load, materialize, row_key, sized

_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    """The host in lower case, '' where the text is no absolute URL or null."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _AUTHORITY, 1))


def url_keys(url: Column) -> Column:
    """The keys an entry can have to apply to ``url``: ``d:`` and the host or a parent domain of two labels or more;
    ``p:``, the host, and the path up to the end of one of its segments."""
    labels = F.split(host_of(url), r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda i: F.concat(F.lit("d:"), F.concat_ws(".", F.slice(labels, i, F.size(labels)))))
    segments = F.filter(F.split(F.regexp_extract(F.coalesce(url, F.lit("")), _PATH, 1), "/"), lambda s: s != "")
    none = F.array().cast("array<string>")
    paths = F.when(F.size(segments) > 0, F.transform(F.sequence(F.lit(1), F.size(segments)), lambda i: F.concat(F.lit("p:"), host_of(url), F.lit("/"), F.concat_ws("/", F.slice(segments, F.lit(1), i))))).otherwise(none)
    return F.when(host_of(url) == "", none).otherwise(F.array_distinct(F.concat(domains, paths)))


def validity(entries: DataFrame) -> DataFrame:
    """``entries`` (list, key, action 'add' or 'remove', at) as intervals [since, until): an addition holds until the
    list's next entry for the key. Of entries at one instant the removal counts. Rows with a null are ignored."""
    w = Window.partitionBy("list", "key").orderBy("at", "action")
    dated = entries.select("list", "key", "action", "at").dropna().withColumn("until", F.lead("at").over(w))
    return dated.where("action = 'add' AND (until IS NULL OR until > at)").select("list", "key", F.col("at").alias("since"), "until")


def evaluate(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", at_col: str = "fetched_at", allow: str = "allow") -> DataFrame:
    """One row for each row of ``captures``: ``id_col``, ``host``, ``at_col``, ``lists`` (sorted names of the lists with
    an entry for the URL that was active at its fetch time), ``n_active`` (such entries) and ``blocked``: a list
    other than ``allow`` has one and ``allow`` has none.

    An interval holds from its start, excluding its end. A capture without a fetch time or an absolute URL matches
    nothing. Repeated captures each give their row. Empty tables give no rows or no matches."""
    spans = materialize(validity(entries), "validity")
    rows = captures.select(F.col(id_col).alias("id"), row_key(id_col, url_col, at_col).alias("row"), F.col(at_col).alias("at"), host_of(F.col(url_col)).alias("host"), url_keys(F.col(url_col)).alias("keys"))
    # Repeated captures have the same keys, so each one is looked up once.
    asked = rows.select("id", "row", "at", F.explode("keys").alias("key"))
    active = asked.join(sized(spans), "key").where("at >= since AND (until IS NULL OR at < until)").select("id", "row", "list", "key").distinct()
    found = active.groupBy("id", "row").agg(F.array_sort(F.collect_set("list")).alias("lists"), F.count(F.lit(1)).alias("n_active"))
    found = materialize(found, "active").withColumnsRenamed({"id": "_id", "row": "_row"})
    lists = F.coalesce("lists", F.array().cast("array<string>"))
    return rows.join(found, rows["id"].eqNullSafe(found["_id"]) & (F.col("row") == F.col("_row")), "left").select(
        F.col("id").alias(id_col), "host", F.col("at").alias(at_col), lists.alias("lists"), F.coalesce("n_active", F.lit(0).cast("bigint")).alias("n_active"),
        (F.exists(lists, lambda x: x != allow) & ~F.array_contains(lists, allow)).alias("blocked"),
    )


def _captures(pages: DataFrame) -> DataFrame:
    """The pages carry no fetch time; they are spread over the days of a year by their id."""
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 37 % 366).cast("int")).alias("fetched_at"))


def _entries(pages: DataFrame) -> DataFrame:
    """Dated entries for the hosts of the pages: by a hash of the host, a list gains and loses it over the year; one
    section in eight of a host is allowed from some day on."""
    hosts = pages.select(host_of(F.col("url")).alias("host")).where("host <> ''").distinct().withColumn("n", F.conv(F.substring(F.md5("host"), 1, 6), 16, 10).cast("int"))
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int"))
    n = F.col("n")
    key = F.concat(F.lit("d:"), "host")
    spam = hosts.where("n % 4 = 0")
    parts = [
        spam.select(F.lit("spam").alias("list"), key.alias("key"), F.lit("add").alias("action"), day(n % 120).alias("at")),
        spam.select(F.lit("spam"), key, F.lit("remove"), day(n % 120 + 90)),
        spam.where("n % 8 = 0").select(F.lit("spam"), key, F.lit("add"), day(n % 120 + 180)),
        hosts.where("n % 5 = 1").select(F.lit("adult"), key, F.lit("add"), day(n % 200)),
    ]
    sections = pages.select(host_of(F.col("url")).alias("host"), F.get(F.filter(url_keys(F.col("url")), lambda k: F.startswith(k, F.lit("p:"))), F.lit(0)).alias("key")).dropna().distinct()
    sections = sections.withColumn("n", F.conv(F.substring(F.md5("key"), 1, 6), 16, 10).cast("int"))
    parts.append(sections.where("n % 8 = 0").select(F.lit("allow"), "key", F.lit("add"), day(n % 300)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``pages`` against the dated entries of three lists."""
    pages = load(spark, sf_dir, "pages").select("page_id", "url")
    out = evaluate(_captures(pages), _entries(pages))
    return out.select("page_id", "host", "fetched_at", F.concat_ws(",", "lists").alias("lists"), "n_active", "blocked")


QUERIES = {"op10_url_filter": op10_url_filter}
ORACLE = {
    "op10_url_filter": r"""
        WITH c AS (SELECT page_id, url, DATE '2024-01-01' + (page_id * 37 % 366)::INT AS fetched_at,
                          lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)', 1)) AS host,
                          list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda s: s <> '') AS seg FROM pages),
        h AS (SELECT DISTINCT host, ('0x' || substr(md5(host), 1, 6))::BIGINT AS n FROM c WHERE host <> ''),
        s AS (SELECT key, ('0x' || substr(md5(key), 1, 6))::BIGINT AS n FROM (SELECT DISTINCT 'p:' || host || '/' || seg[1] AS key FROM c WHERE host <> '' AND len(seg) > 0)),
        e AS (SELECT 'spam' AS list, 'd:' || host AS key, 'add' AS action, DATE '2024-01-01' + (n % 120)::INT AS since FROM h WHERE n % 4 = 0
              UNION ALL SELECT 'spam', 'd:' || host, 'remove', DATE '2024-01-01' + (n % 120 + 90)::INT FROM h WHERE n % 4 = 0
              UNION ALL SELECT 'spam', 'd:' || host, 'add', DATE '2024-01-01' + (n % 120 + 180)::INT FROM h WHERE n % 8 = 0
              UNION ALL SELECT 'adult', 'd:' || host, 'add', DATE '2024-01-01' + (n % 200)::INT FROM h WHERE n % 5 = 1
              UNION ALL SELECT 'allow', key, 'add', DATE '2024-01-01' + (n % 300)::INT FROM s WHERE n % 8 = 0),
        v AS (SELECT * FROM (SELECT *, lead(since) OVER (PARTITION BY list, key ORDER BY since, action) AS until FROM e) WHERE action = 'add' AND (until IS NULL OR until > since)),
        k AS (SELECT page_id, fetched_at, 'd:' || array_to_string(string_split(host, '.')[i:], '.') AS key
              FROM (SELECT *, unnest(range(1, greatest(len(string_split(host, '.')), 2))) AS i FROM c WHERE host <> '')
              UNION SELECT page_id, fetched_at, 'p:' || host || '/' || array_to_string(seg[1:i], '/')
              FROM (SELECT *, unnest(range(1, len(seg) + 1)) AS i FROM c WHERE host <> '')),
        m AS (SELECT page_id, string_agg(DISTINCT list, ',' ORDER BY list) AS lists, count(*) AS n, bool_or(list <> 'allow') AND NOT bool_or(list = 'allow') AS blocked
              FROM k JOIN v USING (key) WHERE fetched_at >= since AND (until IS NULL OR fetched_at < until) GROUP BY page_id)
        SELECT page_id, host, fetched_at, coalesce(lists, '') AS lists, coalesce(n, 0) AS n_active, coalesce(blocked, false) AS blocked FROM c LEFT JOIN m USING (page_id)"""
}
