"""Alignment of trees against textbook matching, pages without any word list, and parsing in linear time."""

import os
import re
import time
from collections import defaultdict

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rillframe.llm import dom, html_extract

SF = "/root/testdata/sf0.1"

trees = st.recursive(st.tuples(st.sampled_from("ab"), st.just(())), lambda inner: st.tuples(st.sampled_from("ab"), st.lists(inner, max_size=4).map(tuple)), max_leaves=12)


def textbook(a, b):
    if a[0] != b[0]:
        return 0
    best = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
    for i, x in enumerate(a[1], 1):
        for j, y in enumerate(b[1], 1):
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + textbook(x, y))
    return best[-1][-1] + 1


@settings(max_examples=300, deadline=None)
@given(trees, trees)
def test_matching_is_that_of_the_textbook(a, b):
    size, pairs = html_extract.matched(a, b)
    assert size == textbook(a, b) == len(pairs)
    x, y = html_extract.flat(a), html_extract.flat(b)
    assert len(set(pairs.values())) == len(pairs) and all(x[i][1] == y[j][1] and (i == 0 or pairs[x[i][0]] == y[j][0]) for i, j in pairs.items())


def test_trees_of_one_template_are_a_cluster():
    extra = "<div class=box><p>Box %d</p></div>"
    page = "<div class=top><p>Menu %d</p></div><div class=main><div class=text><h1>Story %d</h1><p>Text text text text text text text text text text %d</p></div><div class=more></div><div class=end></div></div>{}<div class=foot><p>Foot</p></div>"
    pages = [page.format(extra if i == 3 else "").replace("%d", str(i)) for i in range(6)]  # one page has a box that no other has
    wrapper = html_extract.induce(pages)
    assert len(set(map(str, html_extract.load(wrapper).values()))) == 1
    assert [html_extract.extract(p, wrapper) for p in pages] == [f"Story {i}\n\nText text text text text text text text text text {i}" for i in range(6)]
    assert html_extract.leader_of(2, [[-1, "html"], [0, "a"]], [(1, [[-1, "html"], [0, "b"]])]) == 2


def test_slots_that_vary_outside_the_region_go():
    page = "<div class=x><p>Buy thing %d now</p></div><div class=y><h1>Story %d</h1><p>" + "Long text %d. " * 30 + "</p><div class=z>Written by the staff</div></div><div class=w><p>(c) %d</p></div>"
    pages = [page.replace("%d", str(i)) for i in range(4)]
    wrapper = html_extract.induce(pages)
    assert [html_extract.extract(p, wrapper) for p in pages] == [f"Story {i}\n\n" + " ".join([f"Long text {i}."] * 30) for i in range(4)]
    alone = html_extract.extract(pages[0])  # the word lists alone can't tell
    assert "Buy thing 0 now" in alone and "Written by the staff" in alone


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_article_is_found_without_any_list(monkeypatch):
    by_host = defaultdict(list)
    for url, html in zip(*pq.read_table(f"{SF}/pages.parquet", columns=["url", "html"]).to_pydict().values(), strict=True):
        by_host[re.search("://([^/?#]*)", url)[1]].append(html)
    article = {h: html_extract.extract(re.search("(?s)<article>.*</article>", h)[0]) for pages in by_host.values() for h in pages}
    for name in ("BOILER_WORDS", "BOILER_ROLES", "MAIN_WORDS", "MAIN_TAGS"):
        monkeypatch.setattr(dom, name, frozenset())
    monkeypatch.setattr(dom, "BOILER_TAGS", frozenset(["head", "script", "style", "template"]))
    found = 0
    for host, pages in by_host.items():
        wrapper = html_extract.induce(pages, host)
        found += sum(html_extract.extract(h, wrapper, host) == article[h] for h in pages)
    assert found >= 0.95 * sum(map(len, by_host.values()))


@pytest.mark.parametrize("broken", ['<a "', "<!", "<p><i>", "</b><i>", "<script></script ", "<div>", "<a '>x\"", "<!--", "&"])
def test_broken_markup_is_read_in_linear_time(broken):
    began = time.process_time()
    html_extract.extract(broken * 100_000)
    assert time.process_time() - began < 20


@pytest.mark.parametrize(("html", "text"), [
    ('<p title="a > b">x</p><p title="c>y</p><p>z</p>', "x\n\ny\n\nz"), ("<p>a < b</p><p>c", "a < b\n\nc"), ("<a <p>b", "b"), ("<![if x]>a<!doctype html>b", "ab"), ("<p>x</p></p></div>y", "x\n\ny"),
])
def test_mended_markup(html, text):
    assert html_extract.extract(html) == text
