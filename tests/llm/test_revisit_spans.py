"""As-of joins where times lie unevenly, and long headers."""

import random

import pytest
from pyspark.sql import functions as F

from rillframe.llm import warc


@pytest.mark.parametrize("kind", ["burst", "stray", "one moment"])
def test_hot_urls_match_brute_force(spark, kind):
    random.seed(9)
    time = {"burst": lambda: 10**15 + random.randrange(60), "stray": lambda: random.choice([0, 10**17, *range(10**9, 10**9 + 50)]), "one moment": lambda: random.choice([5, 5, 5, 6])}[kind]
    rows = [(i, random.choice(["http://hot/"] * 9 + ["http://b/"]), time(), random.choice(["response", "revisit"]), None, {}) for i in range(600)]
    got = {r["record_id"]: r["refers_to"] for r in warc.resolve_revisits(spark.createDataFrame(rows, warc.RECORDS), buckets=13).collect()}
    want = {}
    for i, url, at, which, _, _ in rows:
        if which == "revisit":
            earlier = [(t, j) for j, v, t, k, _, _ in rows if k == "response" and v == url and t < at]
            want[i] = max(earlier)[1] if earlier else None
    assert got == want


def test_spans_cut_a_hot_url_by_its_rows(spark):
    rows = spark.range(20_000).select(F.col("id").alias("record_id"), F.lit("http://hot/").alias("url"), F.when(F.col("id") == 0, 0).otherwise(10**15 + F.col("id")).alias("captured_at"), F.when(F.col("id") % 3 == 0, "revisit").otherwise("response").alias("kind"), F.lit(None).cast("string").alias("payload_digest"), F.create_map().cast("map<string,string>").alias("headers"))
    seen = []
    staged, warc.staged = warc.staged, lambda df, name: seen.append((name, staged(df, name))) or seen[-1][1]
    try:
        assert warc.resolve_revisits(rows, buckets=8).where("refers_to is not null and refers_to <> record_id - 1").count() == 0
    finally:
        warc.staged = staged
    sizes = [r["count"] for r in dict(seen)["spans"].groupBy("span").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 20_000 / 8


def test_long_headers_and_clashing_columns(spark):
    long = "x" * 300_000
    rows = [(1, "http://a/", 1, "response", None, {"etag": "1", "x-long": long}), (2, "http://a/", 2, "revisit", None, {"etag": "1", "vary": long}), (3, "http://a/", 2, "other", None, {})]
    records = spark.createDataFrame(rows, warc.RECORDS).withColumns({"full": F.lit(1), "found": F.lit(2), "asked": F.lit(3)})
    (row,) = warc.resolve_revisits(records).collect()
    assert row["headers"] == {"etag": "1", "x-long": long, "vary": long} and row["status"] == "resolved"
