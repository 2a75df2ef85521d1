"""The pipeline's stages on odd rows, clashing columns and empty tables."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_documents import prose

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
CLASH = "kept score lang_pred clear node bucket rep row group piece seen lines ref_lang own_lang h n_words text_key first gone at n".split()


def through(spark, docs, sf_dir):
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found.append(corpus_pipeline.staged(stage(spark, found[-1], sf_dir), name))
    return found[1:]


def test_odd_rows_and_clashing_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = docs.orderBy(F.desc(F.length("text"))).first()
    own = {f.name: f.dataType for f in docs.schema}
    rows = [(9001, None, "en"), (9002, "", "en"), (9003, " \n\t", None), (9004, "12 34 ½ " * 50, "en"), (None, None, None), (None, good["text"], good["lang"]), (9005, good["text"], None), (9005, good["text"], None), (9006, (good["text"] + "\n") * 30, good["lang"]), (9007, "".join("9f3a7c" for _ in range(900)), "en")]
    odd = spark.createDataFrame([(i, t, v, "s", 0) for i, t, v in rows], "doc_id long, text string, lang string, source string, n_chars long").select(*[F.col(c).cast(t) for c, t in own.items()])
    docs = docs.unionByName(odd).withColumns({c: F.lit(f"my {c}") for c in CLASH})
    stages = through(spark, docs, SF)
    ids = []
    for out in stages[:4]:
        assert out.columns == docs.columns and out.where(" or ".join(f"{c} <> 'my {c}'" for c in CLASH)).count() == 0
        ids.append([r["doc_id"] for r in out.select("doc_id").collect()])
    assert not {9001, 9002, 9003, 9004, 9007} & set(ids[0]) and set(ids[1]) <= set(ids[0]) and 100 < len(ids[3]) <= len(ids[2]) < len(ids[1])
    assert ids[2].count(None) == 1 and 9005 not in ids[2]  # a null id is never a copy; the first of equal texts stays
    packed = stages[4].collect()
    assert {r["doc_id"] for r in packed} == set(ids[3]) and all(r["offset"] + r["length"] <= 2048 for r in packed)


def test_corpus_without_labels_or_benchmark(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([(i, prose(i, 60, 4000), None, "s", 1) for i in range(20)] + [(3, prose(3, 60, 4000), None, "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    stages = through(spark, docs, str(tmp_path))
    assert [s.count() for s in stages[:4]] == [21] * 4 and stages[4].count() == 21


def test_empty_documents(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
