"""Piece search and verification as a whole against dynamic programming, and batches of Myers columns against single ones."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rillframe.llm import decontamination as d
from tests.llm.test_documents import documents, prose


def nearest(item, text):
    """The least edits with which an item is in a text."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        above, row = row, [0]
        for i, p in enumerate(item, 1):
            row.append(min(above[i] + 1, row[i - 1] + 1, above[i - 1] + (p != c)))
        best = min(best, row[-1])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text("abé ", min_size=1, max_size=150), st.text("abcé ", max_size=60), st.integers(0, 40)), min_size=1, max_size=8))
def test_columns_of_words_match_single_ones(cases):
    patterns = [d.Pattern(item, k) for item, _, k in cases]
    assert d.distances(patterns, [t for _, t, _ in cases]) == [p.best(t) for p, (_, t, _) in zip(patterns, cases, strict=True)]


def edited(random, text, n):
    chars = list(text)
    for _ in range(n):
        at = random.randrange(len(chars))
        kind = random.randrange(3)
        chars[at : at + (kind != 1)] = [] if kind == 0 else random.choice("abcdefgh")
    return "".join(chars)


@pytest.mark.parametrize("together", [3, 512])
def test_search_finds_what_dynamic_programming_finds(together):
    random.seed(8)
    items = [(i, prose(i, 12 + i % 14, 60)) for i in range(30)] + [(90, prose(3, 15, 60))]  # words that all texts share
    config = d.Config()
    matcher = d.Matcher(items, config, together)
    texts = []
    for i in range(60):
        _, item = items[i % 30]
        budget = int(config.error_rate * len(item))
        texts.append(d.normalised(prose(500 + i, 30, 60) + " " + edited(random, item, random.choice([0, 1, budget, budget + 1, 3 * budget])) + " " + prose(900 + i, 30, 60)))
    for text, found in zip(texts, matcher.search(texts), strict=True):
        want = {}
        for key, item in items:
            item = d.normalised(item)
            distance = nearest(item, text)
            if distance <= int(config.error_rate * len(item)):
                want[key] = distance
        assert {key: distance for key, distance, _ in found} == want


def test_blocks_passes_and_ids(spark):
    items = [(f"i{k}", prose(k, 12, 400)) for k in range(40)]
    texts = [f"{prose(100 + k, 30, 400)} {items[k][1]} {prose(200 + k, 10, 400)}" if k % 3 else prose(300 + k, 50, 400) for k in range(40)] + [None, "", "x " * 200_000 + items[7][1]]
    docs = documents(spark, texts).withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    table = spark.createDataFrame(items, "item_id string, text string")
    want = sorted([(f"d{k}", f"i{k}") for k in range(40) if k % 3] + [("d42", "i7")])
    for config in (d.Config(), d.Config(block_chars=100, held=2, pass_chars=900)):
        assert sorted((r["doc_id"], r["item_id"]) for r in d.find_leaks(docs, table, config).collect()) == want
        assert d.keep(docs, table, config).count() == len(texts) - len(want)
