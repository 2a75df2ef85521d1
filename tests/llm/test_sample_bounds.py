"""The samples that the two models are fitted on: bounded for inputs of any size."""

from pyspark.sql import functions as F

from rillframe.llm import language_id, quality_classifier


def test_windows_are_drawn_from_any_number_of_them(spark):
    rows = spark.range(200_000).select(F.col("id").alias("key"))
    for of, least, most in ((400_000, 1_600, 2_000), (10**12, 0, 5)):  # the second: 250 TB of one language
        n = rows.where(language_id.is_drawn("key", F.lit(3), 3_600, F.lit(of))).count()
        assert least <= n <= most


def test_labels_without_a_document_are_not_sent(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(quality_classifier.F, "broadcast", lambda df: sent.append(df.count()) or df)
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words of text "), F.col("id")).alias("text"))
    labels = spark.range(50_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    model = quality_classifier.fit(docs, labels, quality_classifier.Config(per_class=50, epochs=1))
    assert model is not None and len(sent) == 1 and 40 <= sent[0] <= 160
