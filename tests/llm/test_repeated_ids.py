"""Near duplicates where an id has several texts, where ids are texts, and where buckets hold much that isn't alike."""

import itertools

import numpy as np
import pytest

from rillframe.llm import near_dedup
from tests.llm.test_documents import linked, prose, shingles, variants


@pytest.mark.parametrize("order", list(itertools.permutations(range(4)))[::5])
def test_texts_of_one_id_all_count(spark, order):
    a, b = variants(1, 80, 0, 0)[0], variants(2, 80, 0, 0)[0]
    rows = [(5, a), (5, b), (7, b + " end"), (8, a + " end")]
    got = near_dedup.near_duplicates(spark.createDataFrame([rows[i] for i in order], "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in got) == [(5, 5, True), (5, 5, True), (7, 5, False), (8, 5, False)]


def test_one_id_for_many_texts(spark):
    rows = [(1, prose(k, 30, 4000)) for k in range(40)] + [(2, prose(7, 30, 4000)), (3, prose(99, 30, 4000)), (1, None), (1, "")]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(1, 1), (2, 1), (3, 3)} and len(got) == len(rows)


def test_ids_may_be_texts(spark):
    text = prose(1, 50)
    rows = [("b", text), ("a9", text + " end"), ("c", prose(2, 50)), (None, text)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in got} == {("b", "a9", False), ("a9", "a9", True), ("c", "c", True), (None, None, True)}


def test_copies_that_are_edited_too_much_to_be_alike(spark):
    rng = np.random.default_rng(5)
    original, texts = prose(1, 200, 5000).split(), []
    for k in range(120):  # each differs from the others by more than a quarter; some pairs are alike
        words = list(original)
        for at in rng.choice(200, 7 if k % 4 else 3, replace=False):
            words[at] = f"n{rng.integers(10**9)}"
        texts.append(" ".join(words))
    blocks = [prose(500 + k, 20, 5000) for k in range(8)]
    texts += [" ".join(blocks[i] for i in rng.choice(8, 5, replace=False)) for _ in range(80)]  # passages that many texts share
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    rows = near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == linked(sets)
