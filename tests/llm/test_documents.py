"""Operators on documents against plain Python, and their defined cases."""

import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rillframe.llm import decontamination, language_id, near_dedup, packing, quality_classifier, quality_rules, sharding
from rillframe.llm.components import components
from rillframe.llm.shingles import prepared, shingle_sets

SPACE = "[\x20\x09-\x0d]+"
ODD = [None, "", " \n\t", "a", "a b c d", "a b c d e", "A B c d E", "x " * 40_000, "one two three four five six\none two three four five six\n\n"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, langs=None):
    rows = [(i, t, (langs or {}).get(i, "en"), "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def prose(seed, n, vocabulary=200):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{i}" for i in rng.integers(0, vocabulary, n))


# ---- quality rules


def base(text):
    w, text = words(text), text or ""
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality_features_match_python(spark):
    many = " ".join(prose(k, 30, 12) for k in range(20))  # windows that overlap and recur
    texts = [*ODD, many, many + " " + many, "a # b ** <c>\n\x0b\x85é\u2003z", prose(1, 300), " ".join(f"x{i}" for i in range(99)) + " " + " ".join(f"x{i}" for i in range(99))]
    rows = quality_rules.judge(documents(spark, texts)).orderBy("doc_id").collect()
    for row, text in zip(rows, texts, strict=True):
        n, chars, symbols, lines, repeated = base(text)
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == (n, chars, symbols, lines, repeated), text and text[:40]
        assert row["base_failed"] == (n < 10 or 100 * repeated > 20 * n)
        assert not (row["kept"] and row["base_failed"])


def test_quality_divergence_rejects_other_distributions(spark):
    rng = np.random.default_rng(0)
    common = quality_rules.COMMON_WORDS["en"].split()
    clean = [" ".join(common[rng.integers(len(common))] if rng.random() < 0.4 else f"word{chr(97 + rng.integers(26))}{chr(97 + rng.integers(26))}" for _ in range(400)) + "." for _ in range(40)]
    junk = [clean[0].upper(), re.sub(r"(\w)\b", r"\1***", clean[1])]
    rows = {r["doc_id"]: r["kept"] for r in quality_rules.judge(documents(spark, clean + junk, {3: None, 4: "xx"})).collect()}
    assert all(rows[i] for i in range(40)) and not rows[40] and not rows[41]
    extra = documents(spark, clean[:3]).withColumn("kept", F.lit("mine")).withColumn("n_words", F.lit(0))
    out = quality_rules.judge(extra)
    assert out.first()["kept"] == "mine" and "_kept" in out.columns
    assert quality_rules.keep(extra).columns == extra.columns and quality_rules.keep(extra).count() == 3
    assert quality_rules.judge(empty(spark)).count() == 0


# ---- language ID and quality classifier


def spoken(lang, seed, n=80):
    rng = np.random.default_rng(seed)
    parts = {"en": ["th", "ing", "wh", "ou", "ed"], "fr": ["eau", "é", "ç", "oi", "ent"], "de": ["sch", "ü", "ung", "ß", "ei"]}[lang]
    return " ".join("".join(rng.choice(parts, rng.integers(1, 4))) for _ in range(n))


def test_language_id_held_out_accuracy_and_odd_texts(spark):
    langs = {i: ("en", "fr", "de")[i % 3] for i in range(300)}
    docs = documents(spark, [spoken(langs[i], i) for i in range(300)], langs).withColumn("score", F.lit(7))
    model = language_id.fit(docs)
    rows = language_id.predict(docs, model).collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(held) > 50 and sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) / len(held) > 0.97
    assert all(r["score"] == 7 and 0 <= r["_score"] <= 1 for r in rows)
    odd = language_id.predict(documents(spark, [None, "", "123 !", spoken("fr", 1, 30_000)]), model).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in odd] == ["und", "und", "und", "fr"] and [r["score"] for r in odd[:3]] == [0.0] * 3
    assert language_id.predict(empty(spark), model).count() == 0
    none = language_id.identify(docs.withColumn("lang", F.lit(None).cast("string")).drop("score"))
    assert {r["lang_pred"] for r in none.collect()} == {"und"}
    assert language_id.keep(docs).columns == docs.columns


def test_language_windows_cover_whole_texts():
    model = language_id.train([spoken(x, i).encode() for i in range(30) for x in ("en", "de")], ["en", "de"] * 30)
    text = (spoken("en", 5, 400) + spoken("de", 6, 4000)).encode()
    assert model.scores([text])[0][0] > 0.5 and model.scores([text[:1000]])[0][1] > 0.5  # languages sort as de, en
    blocks = list(language_id.blocks(np.array([5, 0, 9000, 3, 2]), 4096))
    assert blocks[0][0] == 0 and blocks[-1][1] == 5 and all(a[1] == b[0] for a, b in itertools.pairwise(blocks))


def test_quality_classifier(spark):
    texts = [prose(i, 150, 50) if i % 2 else ("$$$ " + prose(i, 60, 50)).upper() for i in range(240)] + [None, ""]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(240)] + [(1, 1, 0), (None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    rows = {r["doc_id"]: r for r in quality_classifier.classify(docs, labels).collect()}
    held = [i for i in range(240) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(rows[i]["predicted"] == i % 2 for i in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows.values()) and rows[240]["score"] == rows[241]["score"]
    assert {r["score"] for r in quality_classifier.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_classifier.classify(empty(spark), labels).count() == 0


def test_attention_weighs_all_passages():
    config = quality_classifier.Config(epochs=2)
    model = quality_classifier.train([b"abc " * 300, b"XYZ " * 300] * 10, [1, 0] * 10, config)
    text = b"abc " * 5000 + b"XYZ " * 9
    assert np.allclose(model.scores([text], block=7), model.scores([text], block=4096))


# ---- packing


def test_packing_round_trip(spark):
    config = packing.public_config(group_tokens=20_000)
    texts = [*ODD, prose(3, 5000), *[prose(i, 50 + i) for i in range(200)]]
    rows = packing.pack_documents(documents(spark, texts), config).collect()
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    plain = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc, by_bin = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_bin[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, text in enumerate(texts):
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own))) and sum(r["length"] for r in own) == len(ids)
        assert (len(own) == 1) == (len(ids) <= 2048) and all(r["length"] == 2048 for r in own[1:])
        assert all(r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) for r in own)
    for places in by_bin.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack_documents(empty(spark), config).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_sum_of_squares_takes_the_smallest_sum(lengths):
    place, offset = packing.sum_of_squares(np.array(lengths, np.int64), 20)
    gaps: dict[int, int] = {}

    def squares(g):
        return sum(c * c for x, c in Counter(g.values()).items() if x)

    for n, at, off in zip(lengths, place.tolist(), offset.tolist(), strict=True):
        options = {b: squares(gaps | {b: g - n}) for b, g in gaps.items() if g >= n} or {"new": squares(gaps | {"new": 20 - n})}
        assert off == 20 - gaps.get(at, 20)
        gaps[at] = gaps.get(at, 20) - n
        assert squares(gaps) == min(options.values())


# ---- decontamination


@settings(max_examples=200, deadline=None)
@given(st.text("abc ", min_size=1, max_size=12), st.text("abc ", max_size=25), st.integers(0, 6))
def test_myers_matches_dynamic_programming(item, text, k):
    row = list(range(len(item) + 1))
    best = None
    for end, c in enumerate(text, 1):
        above = row
        row = [0]
        for i, p in enumerate(item, 1):
            row.append(min(above[i] + 1, row[i - 1] + 1, above[i - 1] + (p != c)))
        if row[-1] <= k and (best is None or row[-1] < best[0]):
            best = (row[-1], end)
    assert decontamination.Pattern(item, k).best(text) == best


def test_leaks_within_the_error_budget(spark):
    items = [prose(1000 + i, 30, 5000) for i in range(6)] + [None, "", "the", prose(1000, 30, 5000)]
    edited = list(items[2])
    for at in (10, 60, 110):
        edited[at] = "q"
    texts = [prose(1, 100), f"{prose(2, 50)} {items[0].upper()}!! {prose(3, 50)}", "".join(edited), items[4][: len(items[4]) // 2], None, "", f"{items[5]}\n\n- {items[3]}", "the " * 500]
    docs = documents(spark, texts)
    table = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], r["distance"]) for r in decontamination.find_leaks(docs, table).collect())
    assert got == [(1, 0, 0), (1, 9, 0), (2, 2, 3), (6, 3, 0), (6, 5, 0)]
    small = decontamination.Config(block_chars=300)
    assert sorted((r["doc_id"], r["item_id"], r["distance"]) for r in decontamination.find_leaks(docs, table, small).collect()) == got
    kept = decontamination.keep(docs, table, small)
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 3, 4, 5, 7] and kept.columns == docs.columns
    assert decontamination.find_leaks(empty(spark), table).count() == 0 and decontamination.keep(docs, table.limit(0)).count() == len(texts)


# ---- near duplicates


def shingles(text):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def linked(sets):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, a), (j, b) in itertools.combinations(sets.items(), 2):
        both = len(a & b)
        if both and 100 * both >= 75 * len(a | b):
            x, y = sorted((find(i), find(j)))
            root[y] = x
    return {i: find(i) for i in sets}


def variants(seed, n, edits, copies):
    rng = np.random.default_rng(seed)
    original = prose(seed, n, 3000).split()
    out = [" ".join(original)]
    for _ in range(copies):
        w = list(original)
        for at in rng.integers(0, n, rng.integers(0, edits + 1)):
            w[at] = f"new{rng.integers(10**6)}"
        out.append(" ".join(w))
    return out


def test_near_duplicates_match_brute_force(spark):
    texts = [*ODD, "A b C d e", "a b c d", *variants(1, 120, 10, 60), *variants(2, 60, 3, 30), *variants(3, 300, 16, 40), *[prose(50 + i, 80, 4000) for i in range(30)]]
    shared = prose(99, 60, 5000)
    texts += [f"{shared} {prose(200 + i, 90, 5000)}" for i in range(30)] + ["Z " + texts[12], texts[12], texts[12].upper()]
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    want = linked(sets)
    rows = near_dedup.near_duplicates(documents(spark, texts)).collect()
    assert {r["doc_id"]: r["n_shingles"] for r in rows} == {i: len(s) for i, s in sets.items()}
    assert {r["doc_id"]: r["component_id"] for r in rows} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_near_duplicates_defined_cases(spark):
    text = prose(1, 40)
    rows = [(5, text), (5, text), (None, text), (3, text), (None, None), (8, None), (9, "")]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in got), key=repr) == sorted([(5, 3, False), (5, 3, False), (None, None, True), (3, 3, True), (None, None, True), (8, 8, True), (9, 9, True)], key=repr)
    assert near_dedup.near_duplicates(empty(spark)).count() == 0
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit(1)).withColumn("bucket", F.lit(2))
    kept = near_dedup.keep(docs)
    assert kept.count() == 5 and kept.columns == docs.columns


def test_shingle_hashes_follow_words():
    texts = ["a b c d e f", "A  B\tc\nd e F", "x", "", "a b c d e f g", "é b c d e f"]
    found = [tuple(s) for s in shingle_sets([prepared(t) for t in texts], block=8)]
    assert found[0] == found[1] and len(found[0]) == 2 and len(found[2]) == 1 and found[3] == () and set(found[0]) < set(found[4]) and len(set(found[5]) & set(found[0])) == 1


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (201, 200), (200, 201)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(30)) and got[201] == got[200] == 200
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


# ---- sharding


def test_sharding_balances_and_numbers(spark):
    texts = [prose(i, 20 + i % 90) for i in range(1500)] + ["copy " * 30] * 700 + [prose(5, 40)] * 9 + [None, None, ""]
    docs = documents(spark, texts)
    rows = sharding.assign(docs, sharding.Config(piece_rows=50)).collect()
    assert len(rows) == len(texts)
    sizes, slots, groups = Counter(), defaultdict(list), defaultdict(set)
    for r in rows:
        text = texts[r["doc_id"]]
        assert r["size"] == len((text or "").encode()) + 8 and r["text_crc32"] == zlib.crc32((text or "").encode()) and r["law"] == "bytes" and r["grown_shard"] is None
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        groups[text].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(sizes) == set(range(24))
    assert max(sizes.values()) < 1.05 * sum(sizes.values()) / 24 and min(sizes.values()) > 0.95 * sum(sizes.values()) / 24
    assert all(len(g) == 1 for t, g in groups.items() if t != "copy " * 30)
    assert sharding.assign(empty(spark)).count() == 0
