"""Queries on pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillframe.llm import html_extract, url_filter, warc
from rillframe.llm.common import table

RULES = [
    url_filter.Rule("allow", "com", "/"), url_filter.Rule("block", "example.com", "/en/"), url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"), url_filter.Rule("block", "net", "/fr/"),
]
# Words of a domain's first label that list it, and marks of symbol noise, all of which list a page's address.
JUNK = ["adult", "ads", "bets", "casino", "pills", "spam"]
NOISE = ["###", "***", "%%%", "$$$"]


def block_list(pages: DataFrame) -> DataFrame:
    """The list of the query, made from the corpus: domains named for junk, and addresses of pages full of symbol noise."""
    host, path = url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))
    junk = F.filter(url_filter.parents(F.col("host")), lambda d: F.arrays_overlap(F.split(F.substring_index(d, ".", 1), "-"), F.array(*map(F.lit, JUNK))))
    domains = pages.select(host.alias("host")).distinct().select(F.explode(junk).alias("host"))
    noisy = reduce(lambda a, b: a & b, [F.contains("html", F.lit(x)) for x in NOISE])
    return domains.unionByName(pages.where(noisy & (host != "") & (path != "")).select(F.concat(host, path).alias("host")))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    listed = block_list(pages.select("url", "html"))
    return url_filter.filter_urls(pages.select("page_id", "url"), RULES, listed).select("page_id", "host", "path", "rule", "verdict")


_NOISY = "coalesce(" + " AND ".join(f"contains(html, '{x}')" for x in NOISE) + ", false)"
OP6_SQL = rf"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path, {_NOISY} AS noisy
  FROM pages),
listed AS (SELECT DISTINCT host || path AS h FROM parts WHERE noisy AND host <> '' AND path <> ''),
judged AS (
  SELECT *, CASE WHEN ('.' || host) LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
                 WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
                 WHEN ('.' || host) LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
                 WHEN ('.' || host) LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
                 WHEN ('.' || host) LIKE '%.com' AND path LIKE '/%' THEN 'com/' END AS rule,
         len(list_intersect(string_split_regex(host, '[.-]'), {JUNK})) > 0 OR (host <> '' AND path <> '' AND host || path IN (SELECT h FROM listed)) AS hit
  FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN hit THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


DAY = 86_400_000_000


def crawl_log(pages: DataFrame) -> DataFrame:
    """The pages as a crawl's records: a response each, and two later answers of the server that nothing was modified.

    The first has the response's entity tag; the second one's tag is of another version for every fifth page.
    """
    at = F.col("page_id") * 60_000_000
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit("")).cast("binary")), F.lit('"'))
    old = F.when(F.col("page_id") % 5 == 0, F.lit('"old"')).otherwise(F.concat(F.lit("W/"), tag))
    record = lambda k, kind, time, digest, headers: F.struct((F.col("page_id") * 3 + k).alias("record_id"), "url", time.alias("captured_at"), F.lit(kind).alias("kind"), digest.alias("payload_digest"), F.create_map(*[F.lit(x) if isinstance(x, str) else x for x in headers]).alias("headers"))
    no_digest = F.lit(None).cast("string")
    records = F.array(
        record(0, "response", at, F.sha1(F.coalesce("html", F.lit("")).cast("binary")), ["content-type", "text/html", "content-length", F.octet_length(F.coalesce("html", F.lit(""))).cast("string"), "etag", tag, "expires", "0"]),
        record(1, "revisit", at + DAY + 1, no_digest, ["etag", tag, "expires", "1", "content-length", "0"]),
        record(2, "revisit", at + 2 * DAY + 2, no_digest, ["etag", old, "vary", "accept"]),
    )
    return pages.select(F.explode(records).alias("r")).select("r.*")


def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.resolve_revisits(crawl_log(table(spark, sf_dir, "pages").select("page_id", "url", "html")))
    headers = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "; ")
    return rows.select("record_id", "canonical_url", "captured_at", "refers_to", "status", headers.alias("headers"))


_TRACKING = warc.TRACKING.replace("'", "''")
OP10_SQL = rf"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body,
    regexp_replace(regexp_replace(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{url_filter.UPPER}', '{url_filter.LOWER}'), '^www\.', ''), ':(80|443)$', '') AS host,
    regexp_replace(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '/+$', '') AS path,
    list_sort(list_filter(string_split(regexp_extract(url, '(?s)^[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '{_TRACKING}'))) AS query,
    contains(url, '://') AS has
  FROM pages),
c AS (SELECT page_id, body, CASE WHEN has THEN host || path || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END END AS canonical_url FROM p),
responses AS (SELECT page_id, page_id * 3 AS record_id, canonical_url, page_id * 60000000 AS ts, '"' || md5(body) || '"' AS etag, strlen(body) AS size FROM c),
revisits AS (
  SELECT record_id + 1 AS record_id, canonical_url, ts + {DAY} + 1 AS captured_at, etag, etag AS sent, 'expires: 1' AS rest FROM responses UNION ALL
  SELECT record_id + 2, canonical_url, ts + 2 * {DAY} + 2, CASE WHEN page_id % 5 = 0 THEN '"old"' ELSE etag END,
         CASE WHEN page_id % 5 = 0 THEN '"old"' ELSE 'W/' || etag END, 'expires: 0; vary: accept' FROM responses),
found AS (
  SELECT v.*, r.record_id AS refers_to, r.etag AS stored, r.size
  FROM revisits v ASOF LEFT JOIN responses r ON v.canonical_url = r.canonical_url AND v.captured_at > r.ts)
SELECT record_id, canonical_url, captured_at, refers_to,
       CASE WHEN refers_to IS NULL THEN 'missing' WHEN etag = stored THEN 'resolved' ELSE 'mismatch' END AS status,
       CASE WHEN refers_to IS NOT NULL AND etag = stored THEN 'content-length: ' || size || '; content-type: text/html; etag: ' || sent || '; ' || rest END AS headers
FROM found
"""

QUERIES = {f.__name__: f for f in (op6_url_filter, op9_html_extraction, op10_warc_revisits)}
ORACLES = {"op6_url_filter": OP6_SQL, "op10_warc_revisits": OP10_SQL}
