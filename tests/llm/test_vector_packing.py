"""Placement against a plain version of the rule, rows without ids, and the files of shards."""

from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from rillframe.llm import packing, sharding
from tests.llm.test_documents import empty, prose


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(*[st.integers(1, 50)] * 3), max_size=40), st.integers(1, 5))
def test_place_follows_the_rule(groups, shards):
    unit = [max(1, sum(g[d] for g in groups)) / shards for d in range(3)]
    shares = [[g[d] / unit[d] for d in range(3)] for g in groups]
    got = sharding.place(np.array(shares).reshape(-1, 3), np.ones((shards, 3)))
    room = [[1.0] * 3 for _ in range(shards)]
    for i in sorted(range(len(shares)), key=lambda i: -max(shares[i])):
        gain = [sum(a * b for a, b in zip(r, shares[i], strict=True)) for r in room]
        assert gain[got[i]] >= max(gain) - 1e-9 and all(g < gain[got[i]] + 1e-9 for g in gain[: got[i]])
        room[got[i]] = [a - b for a, b in zip(room[got[i]], shares[i], strict=True)]


def test_blocks_of_groups_stay_balanced(spark):
    texts = [prose(i, 5 + i % 60) for i in range(3000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    encode = packing.encoder(*(lambda c: (c.ranks, c.pattern))(packing.public_config())).encode
    rows = sharding.assign(docs, sharding.Config(block_groups=300)).collect()
    sums = {k: np.zeros(3) for k in range(24)}
    for r in rows:
        sums[r["shard"]] += (r["size"], len(encode(texts[r["doc_id"]])), 1)
    table = np.array(list(sums.values()))
    assert (abs(table / table.mean(axis=0) - 1) < 0.05).all()


def test_rows_without_ids_are_spread(spark):
    rows = [(None, "same text")] * 900 + [(7, "other text")] * 900 + [(None, prose(i, 9)) for i in range(300)] + [(1, None), (None, None), (2, "")]
    got = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), sharding.Config(piece_rows=10)).collect()
    slots, hot = defaultdict(list), Counter()
    for r in got:
        slots[r["shard"]].append(r["slot"])
        hot[r["doc_id"], r["size"], r["shard"]] += 1
    assert len(got) == len(rows) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) < 1.35 * len(rows) / 24 and max(hot.values()) < 200
    assert sharding.assign(empty(spark)).count() == 0


def test_write_shards(spark, tmp_path):
    rows = [(i, prose(i % 50, 20), "x") for i in range(200)] + [(None, None, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    sharding.write_shards(docs, str(tmp_path / "out"), sharding.Config(shards=3))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(out.columns) == ["_shard", "doc_id", "shard", "text"]
    back = out.collect()
    assert sorted(map(repr, ((r["doc_id"], r["text"], r["shard"]) for r in back))) == sorted(map(repr, rows))
    own = defaultdict(set)
    for r in back:
        own[r["text"]].add(r["_shard"])
    assert {r["_shard"] for r in back} == {0, 1, 2} and all(len(s) == 1 for s in own.values())
