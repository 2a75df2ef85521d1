"""What the language stage rejects, and odd rows of language ID."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillframe.llm import language_id
from tests.llm.test_documents import documents, empty, spoken

LANGS = {i: ("en", "fr", "de")[i % 3] for i in range(240)}


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, [spoken(LANGS[i], i) for i in range(240)], LANGS).cache()


def junk():
    rng = np.random.default_rng(3)
    draw = lambda alphabet, n: "".join(rng.choice(list(alphabet), n))
    return [draw("0123456789abcdef", 900), draw("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 1500), " ".join(draw("abcdefghijklmnopqrstuvwxyz", k % 7 + 2) for k in range(200))]


def test_texts_of_no_language_go_and_texts_of_several_stay(spark, docs):
    both = spoken("en", 901, 200) + "\n" + spoken("de", 902, 200)
    mostly = spoken("fr", 903, 400) + "\n" + junk()[0][:200]
    texts = [*junk(), None, "", "12 ½ ² ①", both, mostly, spoken("fr", 904, 50)]
    odd = documents(spark, texts).withColumns({"doc_id": F.col("doc_id") + 1000, "lang": F.lit(None).cast("string")})
    kept = {r["doc_id"] for r in language_id.keep(docs.unionByName(odd)).collect()}
    assert {i for i in kept if i >= 1000} == {1006, 1007, 1008}
    assert len(kept) - 3 == 240  # none of the labelled texts goes


def test_without_labels_only_letterless_texts_go(spark):
    docs = documents(spark, ["some words", "x", "123", "", None, "½"]).withColumn("lang", F.lit(None).cast("string"))
    assert {r["doc_id"] for r in language_id.keep(docs).collect()} == {0, 1}
    held_out = documents(spark, ["some words"]).withColumn("doc_id", F.lit(next(i for i in range(99) if zlib.crc32(str(i).encode()) % 4 == 2)).cast("long"))  # a fold that isn't learned from
    assert language_id.fit(held_out) is None and language_id.keep(held_out).count() == 1
    assert language_id.keep(empty(spark)).count() == 0


def test_repeated_rows_ties_and_numerals(spark, docs):
    model = language_id.fit(docs)
    text = spoken("de", 77)
    rows = language_id.predict(documents(spark, [text, "½ ² ①", text, "Ⅷ٣", "٣ a", text]), model, clear=True).orderBy("doc_id").collect()
    assert len({(r["lang_pred"], r["score"], r["clear"]) for r in (rows[0], rows[2], rows[5])}) == 1 and rows[0]["lang_pred"] == "de"
    assert [r["lang_pred"] for r in (rows[1], rows[3])] == ["und", "und"] and rows[1]["score"] == 0 and rows[4]["lang_pred"] != "und"
    same = language_id.train([b"abc " * 60] * 40, ["b", "a"] * 20, language_id.Config(epochs=1, least_steps=1))
    same.out[:, 1], same.out_bias[1] = same.out[:, 0], same.out_bias[0]
    assert same.languages[same.scores([b"abc " * 60])[0].argmax()] == "a"


def test_windows_come_from_anywhere_in_a_text(spark, docs):
    long = [(spoken("en", 5, 20_000), "en"), (spoken("fr", 6, 300), "fr"), (spoken("de", 7, 300), "de")]
    table = spark.createDataFrame([(i, t, v) for i, (t, v) in zip((0, 1, 4), long, strict=True)], "doc_id long, text string, lang string")
    config = language_id.Config(per_language=40, total=90, least_steps=10)
    seen = []
    train, language_id.train = language_id.train, lambda texts, labels, config: seen.append((texts, labels)) or train(texts, labels, config)
    try:
        language_id.fit(table, config)
    finally:
        language_id.train = train
    places = [long[0][0].encode().find(w) // 256 for w, v in zip(*seen[0], strict=True) if v == "en"]
    assert 10 <= len(places) <= 60 and max(places) > 200 and min(places) < 150 and all(len(w) <= 256 for w in seen[0][0])


def test_columns_that_clash(spark, docs):
    more = docs.withColumns({"lang_pred": F.lit(1), "clear": F.lit(2), "at": F.lit(3), "all": F.lit(4), "n": F.lit(5)})
    out = language_id.predict(more.limit(3), language_id.fit(more), clear=True)
    assert out.columns == [*more.columns, "_lang_pred", "score", "_clear"] and out.first()["clear"] == 2
    assert language_id.keep(more).columns == more.columns
