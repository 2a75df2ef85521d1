"""The quality rules on texts of a hundred words or so."""

import numpy as np

from rillframe.llm import quality_rules


def test_word_lists_of_a_hundred_words_are_rejected(spark):
    rng = np.random.default_rng(1)
    common = quality_rules.COMMON_WORDS["en"].split()
    invented = lambda: "".join(chr(97 + k) for k in rng.integers(0, 26, 6))
    prose = lambda n: " ".join(common[rng.integers(len(common))] if rng.random() < 0.4 else invented() for _ in range(n))
    texts = [*[prose(400) for _ in range(20)], *[prose(150) for _ in range(5)], *[" ".join(invented() for _ in range(n)) for n in (80, 100, 150, 199, 250)]]
    docs = spark.createDataFrame([(i, "en", t) for i, t in enumerate(texts)], "doc_id long, lang string, text string")
    rows = {r["doc_id"]: r["kept"] for r in quality_rules.judge(docs).collect()}
    assert [i for i, kept in sorted(rows.items()) if not kept] == [25, 26, 27, 28, 29]
