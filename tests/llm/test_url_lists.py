"""Lists of thousands of keys against plain sets, in shards and passes, and odd rows."""

import random

import pytest
from pyspark.sql import functions as F

from rillframe.llm import url_filter


@pytest.mark.parametrize(("level", "together"), [(1 << 23, 1 << 26), (8_000, 20_000)])
def test_long_lists_match_sets(spark, level, together):
    random.seed(3)
    hosts = [f"h{i}.{random.choice('abc')}.example.{random.choice(['org', 'net'])}" for i in range(4000)]
    listed = set(random.sample(hosts, 700)) | {"c.example.net"} | {f"{h}/p/{i % 7}" for i, h in enumerate(random.sample(hosts, 900))}
    rows = [(i, f"http://{random.choice(hosts)}/p/{i % 9}?q={i}") for i in range(9000)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    table = spark.createDataFrame([(x,) for x in [*listed, *list(listed)[:50], "absent.example", "absent.example/x"]], "host string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.filter_urls(pages, [], table, max_level_bits=level, pass_bits=together).collect()}
    for i, url in rows:
        host, path = url[7:].split("/", 1)[0], "/" + url[7:].split("/", 1)[1].split("?")[0]
        labels = host.split(".")
        hit = host + path in listed or any(".".join(labels[k:]) in listed for k in range(len(labels)))
        assert got[i] == ("block" if hit else "allow")


def test_shards_hold_their_bound(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"), "id")
    made = list(url_filter.build_shards(universe.where("id % 5 = 0").select("key"), universe.select("key"), max_level_bits=3000))
    assert len(made) > 3 and all(len(c.levels[0].table) * 8 < 1.3 * 3000 for _, _, c in made)
    assert sum(url_filter.build_cascade(universe.where("id < 0").select("key"), universe.select("key")).bits for _ in range(1)) == 0


def test_repeated_rows_and_long_urls(spark):
    long = "http://www.spam.org/" + "a/" * 50_000
    rows = [(1, long), (1, long), (2, "http://" + "b." * 300 + "org/x"), (3, None), (4, "http://x.org")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({"keys": F.lit(1), "hit": F.lit(2), "verdict": F.lit("mine")})
    listed = spark.createDataFrame([("SPAM.org",), ("b.org",), (None,), ("",), ("x.org/",)], "host string")
    out = url_filter.filter_urls(pages, [], listed)
    assert sorted((r["page_id"], r["_verdict"]) for r in out.collect()) == [(1, "block"), (1, "block"), (2, "block"), (3, "allow"), (4, "allow")]
    assert out.columns == ["page_id", "url", "keys", "hit", "verdict", "host", "path", "rule", "_verdict"]
