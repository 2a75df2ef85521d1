"""Operators on pages against plain Python, and their defined cases."""

import pytest
from pyspark.sql import functions as F

from rillframe.llm import html_extract, url_filter, warc
from rillframe.llm.dom import parse, text_blocks

RULES = [url_filter.Rule("allow", "com", "/"), url_filter.Rule("block", "example.com", "/en/")]


# ---- URL filter


@pytest.mark.parametrize("limit", [1 << 23, 1])
def test_urls(spark, limit):
    urls = ["http://A.Example.com/en/x?y", "https://b.org", "https://x.bad.org/p#f", "ftp://bad.org?q", "http://notbad.org/", None, "no scheme", "http://example.com/en", "a://b://c/d", "http:///x", "http://com/\nq"]
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)], "page_id long, url string, host string")
    listed = spark.createDataFrame([("BAD.org",), ("absent.net",), (None,), ("bad.org",)], "host string")
    rows = url_filter.filter_urls(pages, RULES, listed, max_level_bits=limit).orderBy("page_id").collect()
    assert [r["host"] for r in rows] == ["mine"] * len(urls)
    assert [(r["_host"], r["path"], r["rule"], r["verdict"]) for r in rows] == [
        ("a.example.com", "/en/x", "example.com/en/", "block"), ("b.org", "", None, "allow"), ("x.bad.org", "/p", None, "block"), ("bad.org", "", None, "block"),
        ("notbad.org", "/", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("example.com", "/en", "com/", "allow"), ("b:", "//c/d", None, "allow"),
        ("", "/x", None, "allow"), ("com", "/\nq", "com/", "allow"),
    ]
    assert url_filter.filter_urls(pages.limit(0), RULES, listed).count() == 0


@pytest.mark.parametrize("share", [2, 9, 300, 10_000])
def test_cascade_is_exact_over_its_universe(spark, share):
    universe = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key"), "id")
    listed = universe.where(F.col("id") % share == 0).select("key")
    cascade = url_filter.build_cascade(listed, universe.select("key"))
    wrong = universe.where(cascade.lists(F.col("key")) != (F.col("id") % share == 0))
    assert wrong.count() == 0 and (share > 1000 or len(cascade.levels) > 1)


# ---- HTML


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="ad"><nav><a>Home</a></nav><div class="ad-slot">Buy %d</div>
<div class="post"><h2>Story %d</h2><p>First &amp; only <b>bold</b>text&nbsp;%d<br>next<p>Second   para %d<script>x("</p>")</script></div>
<div class="comments"><p>me %d too</p></div><div>All rights reserved</div><footer>F %d</footer></body></html>"""


def test_wrapper_finds_content_without_semantic_elements():
    pages = [PAGE.replace("%d", str(i)) for i in range(6)]
    wrapper = html_extract.induce(pages[:4])
    for i, page in enumerate(pages):
        assert html_extract.extract(page, wrapper) == f"Story {i}\n\nFirst & only boldtext {i} next\n\nSecond para {i}"
    assert "All rights reserved" in html_extract.extract(pages[0])  # which alignment alone can tell from content


def test_simple_tree_matching():
    tree = lambda s: (s[0], tuple(tree(c) for c in s[1:]))
    a, b = tree(["a", ["b", ["c"], ["d"]], ["e"]]), tree(["a", ["x"], ["b", ["d"]], ["e", ["f"]]])
    assert html_extract.matched(a, b)[0] == 4 and html_extract.matched(a, tree(["z"]))[0] == 0 and html_extract.matched(a, a)[0] == 5


@pytest.mark.parametrize(("html", "text"), [
    (None, ""), ("", ""), ("plain", "plain"), ("<article>A<article>B</article></article>", "A\n\nB"), ("<p>a<p>b", "a\n\nb"), ("<ul><li>a<li>b</ul>", "a\n\nb"),
    ("<main><header>h</header><h1>T</h1><form>f</form><p>x &lt; y<!-- c --></p></main><p>out</p>", "T\n\nx < y"), ("<article><p>a</div></p>b</article>", "a\n\nb"),
    ("<div>a</div><div class='Cookie-notice'>c</div><aside>s</aside><p hidden>d", "a\n\nd"), ("<p title=\"a > b\">x</p><p title='unclosed>y", "x\n\ny"),
    ("<div class='has-sidebar no-comments'>a<p id=top_ad_1>b</p></div>", "a"), ("<article class='comment'>c</article><article class=post>d</article>", "d"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1 2\n\n3"), ("a &bogus; &#233;&#x41; <", "a &bogus; éA <"), ("<script>if (a<b) </scr", ""), ("<p>\x0b x\n\ty </p>" * 2, "x y\n\nx y"),
])
def test_extraction_cases(html, text):
    assert html_extract.extract(html) == text


def test_deep_trees_do_not_recurse():
    assert html_extract.extract("<div>" * 3000 + "deep" + "</div>" * 10) == "deep"
    assert text_blocks([parse("<b>x</b>")], set()) == ["x"]


def test_extract_text(spark):
    rows = [(i, f"http://h.example/{i}", PAGE.replace("%d", str(i)), "t") for i in range(20)] + [(90, None, "<p>x", "t"), (91, "http://h.example/n", None, "t"), (92, "http://one.example", "<article>y</article>", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = html_extract.extract_text(pages)
    got = {r["page_id"]: (r["_text"], r["n_chars"]) for r in out.collect()}
    assert len(got) == 23 and "html" not in out.columns
    assert all(got[i][0] == f"Story {i}\n\nFirst & only boldtext {i} next\n\nSecond para {i}" for i in range(20))
    assert got[90] == ("x", 1) and got[91] == ("", 0) and got[92] == ("y", 1)
    assert html_extract.extract_text(pages.limit(0)).count() == 0


# ---- WARC


def test_warc_round_trip(spark, tmp_path):
    first = warc.write_record("response", "http://a.b/c", "2024-01-01T00:00:00Z", {"ETag": '"1"', "X-A": "é"}, b"body\r\n\r\nWARC/1.1", extra={"WARC-Record-ID": "<r1>"})
    second = warc.write_record("revisit", "http://a.b/c", "2024-01-02T00:00:00Z", {"ETag": '"1"'}, status="304 Not Modified")
    (tmp_path / "a.warc.gz").write_bytes(first + second)
    (tmp_path / "b.warc").write_bytes(warc.write_record("response", "http://x/", "d", {}, b"", compressed=False) + b"junk")
    (tmp_path / "c.warc").write_bytes(b"")
    rows = sorted(warc.read_warc(spark, str(tmp_path)).collect(), key=lambda r: (r["path"], r["position"]))
    assert [(r["kind"], r["url"], r["status"], bytes(r["payload"])) for r in rows] == [
        ("response", "http://a.b/c", "HTTP/1.1 200 OK", b"body\r\n\r\nWARC/1.1"), ("revisit", "http://a.b/c", "HTTP/1.1 304 Not Modified", b""), ("response", "http://x/", "HTTP/1.1 200 OK", b"")]
    assert rows[0]["headers"] == {"etag": '"1"', "x-a": "é"} and rows[0]["warc_fields"]["warc-record-id"] == "<r1>"


def test_canonical_urls(spark):
    urls = ["HTTP://WWW.A.com:80/x/?utm_source=1&b=2&a=1#f", "https://a.com/x?a=1&b=2", "a.com", None, "http://a.com", "http://a.com/?ref=3"]
    got = [r[0] for r in spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string").orderBy("i").select(warc.canonical_url(F.col("u"))).collect()]
    assert got == ["a.com/x?a=1&b=2", "a.com/x?a=1&b=2", None, None, "a.com", "a.com"]


def resolved(spark, rows, **options):
    records = spark.createDataFrame(rows, warc.RECORDS).withColumn("span", F.lit("mine"))
    return {r["record_id"]: (r["refers_to"], r["status"], r["headers"]) for r in warc.resolve_revisits(records, **options).collect()}


def test_revisits(spark):
    u = "http://a.com/x"
    rows = [
        (1, u, 10, "response", "d1", {"etag": '"1"', "content-type": "t", "expires": "0"}), (2, u, 20, "response", "d2", {"etag": '"2"', "last-modified": "m"}),
        (3, u, 20, "response", "d3", {"etag": '"3"'}), (4, u, 10, "revisit", None, {}), (5, u, 15, "revisit", None, {"etag": 'W/"1"', "expires": "9", "content-length": "0", "x": "y"}),
        (6, u, 99, "revisit", None, {"etag": '"2"'}), (7, u, 99, "revisit", "d3", None), (8, "http://b.com", 50, "revisit", None, {}), (9, None, 50, "revisit", None, {}),
        (10, u, None, "revisit", None, {}), (11, u, None, "response", "d", {}), (12, u, 21, "revisit", "other", {"last-modified": "m"}), (7, u, 99, "revisit", "d3", None),
    ]
    want = {
        4: (None, "missing", None), 5: (1, "resolved", {"content-type": "t", "etag": 'W/"1"', "expires": "9"}), 6: (3, "mismatch", None), 7: (3, "resolved", {"etag": '"3"'}),
        8: (None, "missing", None), 9: (None, "missing", None), 10: (None, "missing", None), 12: (3, "mismatch", None),
    }
    for buckets in (1, 3, 1024):
        assert resolved(spark, rows, buckets=buckets) == want
    assert resolved(spark, []) == {}


def test_as_of_matches_brute_force(spark):
    import random

    random.seed(4)
    rows = [(i, f"http://h/{random.choice('aaab')}", random.randrange(300), random.choice(["response", "revisit"]), None, {}) for i in range(400)]
    got = resolved(spark, rows, buckets=16)
    for i, url, at, kind, _, _ in rows:
        if kind == "revisit":
            earlier = [(t, j) for j, v, t, k, _, _ in rows if k == "response" and v == url and t < at]
            assert got[i][0] == (max(earlier)[1] if earlier else None)


def test_payloads_join(spark):
    resolved_rows = spark.createDataFrame([(5, 1, "resolved"), (6, 1, "mismatch"), (7, None, "missing")], "record_id long, refers_to long, status string")
    payloads = spark.createDataFrame([(1, b"x")], "record_id long, payload binary")
    assert {r["record_id"]: r["payload"] and bytes(r["payload"]) for r in warc.attach_payloads(resolved_rows, payloads).collect()} == {5: b"x", 6: None, 7: None}
