"""Wrappers against what article elements, drawn pages and cut trees would miss."""

from rillframe.llm import html_extract


def test_wrapper_decides_before_article_elements():
    page = "<body><div>Lead %d</div><article><h1>Story %d</h1><p>Text %d</p><div>Written by <a>the staff</a></div></article></body>"
    pages = [page.replace("%d", str(i)) for i in range(5)]
    wrapper = html_extract.induce(pages)
    assert [html_extract.extract(p, wrapper) for p in pages] == [f"Lead {i}\n\nStory {i}\n\nText {i}" for i in range(5)]
    assert html_extract.extract(pages[0], html_extract.induce(pages[:1])) == "Story 0\n\nText 0\n\nWritten by the staff"  # no region: the article
    assert html_extract.extract(pages[0], html_extract.induce(pages[:1] * 3)) == "Story 0\n\nText 0\n\nWritten by the staff"


def test_every_page_of_a_host_counts(spark):
    usual, rare, odd = "<div class=a><p>Usual %d</p><p>All rights</p></div>", "<div class=b><p>Rare %d</p><p>Some rights</p></div>", "<div class=a><p>Odd %d</p></div>"
    kinds = [rare if i % 100 == 7 else odd if i % 50 == 3 else usual for i in range(300)]
    pages = spark.createDataFrame([(i, f"http://h.example/{i}", k.replace("%d", str(i))) for i, k in enumerate(kinds)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract_text(pages).collect()}
    assert got == {i: f"{'Rare' if k is rare else 'Odd' if k is odd else 'Usual'} {i}" for i, k in enumerate(kinds)}


def test_long_pages_are_not_cut():
    page = lambda i, n: f"<body><h1>Story {i}</h1><div class=text>{''.join(f'<h2>Part {i}.{k}</h2><p>Text {i}.{k}</p>' for k in range(n))}</div><div class=x>All rights</div></body>"
    pages = [page(0, 500), page(1, 3), page(2, 3000)]
    wrapper = html_extract.induce(pages)
    for i, n in enumerate((500, 3, 3000)):
        blocks = [f"Story {i}", *[f"{what} {i}.{k}" for k in range(n) for what in ("Part", "Text")]]
        assert html_extract.extract(pages[i], wrapper) == "\n\n".join(blocks)


def test_paths_are_the_largest_match_of_folded_trees():
    a, b = "<div class=a><p>1<h2>2</h2><p>3</div><section><p>4</section>", "<section><p>4<ul><li>5</ul></section><div class=a><h2>6</h2></div>"

    def folded(nodes, names):
        paths = {}
        for n in nodes:
            for c in n.children:
                if not isinstance(c, str):
                    paths.setdefault(c.name, []).append(c)
        return names[-1], tuple(folded(paths[k], [*names, k]) for k in sorted(paths))

    def paths(shape, above=()):
        at = (*above, shape[0])
        return {at}.union(*[paths(c, at) for c in shape[1]])

    x, y = (folded([html_extract.parse(h)], ["html"]) for h in (a, b))
    assert html_extract.matched(x, y)[0] == len(paths(x) & paths(y)) == 5
