"""Packing's ids against the tokenizers library: the special token, and long texts that are encoded in parts."""

import zlib
from functools import lru_cache

import hypothesis
import numpy as np
import pytest
from hypothesis import strategies as st

from rillframe.llm import packing


def test_special_tokens_have_the_ids_of_the_file(spark):
    plain = dealt()
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "x\n<|endoftext|>\n y", "<|endoftext|", "<|EndOfText|>", "no such"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in packing.pack_documents(docs, packing.public_config()).collect()}
    for i, text in enumerate(texts):
        ids = np.array([*plain.encode(text, add_special_tokens=False).ids, 0], "<u4")
        assert (rows[i]["length"], rows[i]["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))
    assert 50256 in plain.encode(texts[0], add_special_tokens=False).ids


PARTS = ["a", "Word", "'s", " ", "  ", " \n ", "\n", "\t", "\x1c", "\x1f", "\x85", "\u00a0", "\u1680", "\u200b", "\u2003", "\u2028", "\u202f", "\u3000", "\ufeff", "\u180e", "7", "12", "!", "...", "é", "e\u0301", "漢字", "\U0001f600", "<|endoftext|>", "\x00"]


@hypothesis.settings(max_examples=500, deadline=None)
@hypothesis.given(st.lists(st.sampled_from(PARTS), max_size=60).map("".join), st.integers(1, 12))
def test_parts_have_the_ids_of_the_whole(text, most):
    made = list(packing.parts(text, most))
    assert "".join(made) == text and all(len(p) > most for p in made[:-1])
    got = np.concatenate(list(packing.ids(text, packing.public_config(part_chars=most)))).tolist()
    assert got == dealt().encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=1)
def dealt():
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    return tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
