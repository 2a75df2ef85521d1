"""Hosts with more trees than lead in a round: none that another one matches is left alone."""

import json
import random

from rillframe.llm import html_extract as he


def plain_clusters(order):
    """By the plain rule, without an index: order is (shape, tree), frequent ones first."""
    cluster, size = {}, he.LEADERS
    while order:
        leaders = order[:size]
        own = {s: he.leader_of(s, t, leaders) for s, t in order}
        led = {s for s, _ in leaders}
        cluster |= {s: c for s, c in own.items() if c != s or s in led}
        order, size = [(s, t) for s, t in order if s not in cluster], min(he.MORE * size, he.MOST)
    return cluster


def random_trees(count, seed=1):
    """Trees that share sections, some swapped, some repeated, some of their own, so that pairs of all similarities occur."""
    draw, out = random.Random(seed), []
    for k in range(count):
        if out and draw.random() < 0.5:
            tree = [list(node) for node in draw.choice(out)]
            tree[draw.randrange(1, len(tree))][1] = f"div.n{k}"
        else:
            tree = [[-1, "html", 0]]
            for _ in range(draw.randrange(2, 14)):
                tree.append([draw.randrange(len(tree)), f"div.{draw.choice('abcdefgh')}{draw.randrange(3)}", 0])
        out.append(tree)
    return list(enumerate({json.dumps(t): t for t in out}.values()))


def test_clusters_are_those_of_the_plain_rule(spark):
    trees = random_trees(700)
    shapes = spark.createDataFrame([(home, home * 10_000 + s, max(1, 9 - s), json.dumps(t)) for home in (0, 1) for s, t in trees[: None if home else 5]], "home long, shape long, n long, tree string")
    want = plain_clusters(trees)
    assert len(set(want.values())) > 10 * he.LEADERS and any(c >= he.LEADERS and s != c for s, c in want.items())
    got = {r["shape"]: r["cluster"] for r in he._clusters(shapes).collect()}
    assert {s - 10_000: c - 10_000 for s, c in got.items() if s >= 10_000} == want
    assert {s: c for s, c in got.items() if s < 10_000} == plain_clusters(trees[:5])


def test_rare_trees_of_a_host_with_many_layouts_share_a_template(spark):
    layout = lambda k, i: f"<body><div class=q{chr(97 + k // 26)}{chr(97 + k % 26)}><section class=s{chr(97 + k % 26)}><p>Layout {k} page {i}</p></section></div></body>"
    rare = lambda i: f"<body><div class=x><div class=y><p>Story {i}</p></div><div class=z><p>All rights</p></div><div class=u></div><div class=w></div></div><div class=only{'pqr'[i]}></div></body>"
    html = [layout(k, i) for k in range(40) for i in range(3)] + [rare(i) for i in range(3)]
    want = [f"Layout {k} page {i}" for k in range(40) for i in range(3)] + [f"Story {i}" for i in range(3)]
    wrappers = he.induce(html)
    assert [he.extract(h, wrappers) for h in html] == want
    pages = spark.createDataFrame([(i, f"http://h.example/{i}", h) for i, h in enumerate(html)], "page_id long, url string, html string")
    assert [r["text"] for r in he.extract_text(pages).orderBy("page_id").collect()] == want
