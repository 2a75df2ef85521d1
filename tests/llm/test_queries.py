"""The registered queries on the driver's smallest tables: against SQL, and the pipeline against plain Python."""

import itertools
import os
import re

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from rillframe.llm import registry
from rillframe.llm.common import table
from rillframe.llm.decontamination import normalised

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def views():
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, name):
    got, want = registry.queries()[name](spark, SF).toPandas(), views().sql(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda f: sorted(tuple("" if v is None or v != v else str(v).removesuffix(".0") for v in r) for r in f[sorted(want.columns)].itertuples(index=False))
    assert rows(got) == rows(want)


def test_every_operator_is_registered_once():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n[2].isdigit()) == list(range(1, 11)) and "pipeline" in __spark_entry__.queries()


def shingles(text):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def test_pipeline_against_python(spark):
    con = views()
    texts = dict(con.sql("select doc_id, text from documents").fetchall())
    good = {r[0] for r in con.sql(f"select doc_id from ({registry.oracle_sql()['op1_quality_rules']}) where kept").fetchall()}
    stages = dict(corpus_pipeline.STAGES)
    docs = table(spark, SF, "documents")
    one = stages["quality_rules"](spark, docs, SF)
    assert one.columns == docs.columns and {r["doc_id"] for r in one.collect()} == good
    spoken = {r["doc_id"] for r in stages["language_id"](spark, one, SF).collect()}
    assert spoken <= good and len(spoken) >= 0.97 * len(good)
    sets = {i: shingles(texts[i]) for i in sorted(spoken)}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, a), (j, b) in itertools.combinations(sets.items(), 2):
        both = len(a & b)
        if 100 * both >= 75 * (len(a) + len(b) - both):
            x, y = sorted((find(i), find(j)))
            root[y] = x
    items = [normalised(t) for (t,) in con.sql("select text from benchmark").fetchall()]
    want = {i for i in sets if find(i) == i and not any(x in normalised(texts[i]) for x in items)}
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in packed} == want
    full = {}
    for r in packed:
        full.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert all(sum(n for _, n in v) <= 2048 and sum(n for _, n in v) == max(o + n for o, n in v) for v in full.values())
