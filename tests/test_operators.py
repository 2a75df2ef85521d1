"""Operators on small tables with results written by hand, and against plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from rillframe import schemas as S
from rillframe.functions import hashing
from rillframe.functions.expressions import chunk_id, comma_list, diffed_status, episode_index, float_list, frame_count, issues, parse_since, rate, zscore
from rillframe.operators import align, manifest
from rillframe.operators.moments import reduce_moments, usable
from rillframe.operators.ordered import numbered, ordering_summary
from rillframe.plans.steps import split_counts
from rillframe.sources.jsonl import parse_ids, parse_stats


def values(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.mark.parametrize("width", [2, 1000])
def test_ordering_is_the_same_for_any_block_width(spark, width):
    random.seed(5)
    rows = [(k, i, random.choice([i, i, i, None, 3]), random.choice([float(i), float(i), None, math.nan])) for k in "abcdef" for i in range(random.randrange(1, 12))]
    df = spark.createDataFrame(rows, "k string, row long, f long, t double")
    got = ordering_summary(df, ["k"], "row", strict=["f"], ascending=["t"], ends=["f"], aggregates=[F.count("*").alias("n_rows")], width=width)
    up = lambda a, b, strict: a is None or b is None or (b > a if strict else (math.isnan(b) or (b >= a and not math.isnan(a))))
    want = []
    for k in "abcdef":
        own = [r for r in rows if r[0] == k]
        pairs = list(zip(own, own[1:], strict=False))
        want.append((k, all(up(a[2], b[2], True) for a, b in pairs), all(up(a[3], b[3], False) for a, b in pairs), own[0][2], own[-1][2], len(own)))
    assert values(got, "k", "f_sorted", "t_sorted", "f_first", "f_last", "n_rows") == sorted(want, key=repr)


def test_numbering_spans_blocks_and_puts_null_first(spark):
    df = spark.createDataFrame([("a", None), ("a", 5), ("a", 1), ("a", 900), ("b", 7)], "k string, o long")
    assert values(numbered(df, ["k"], "o", "at", width=3), "k", "o", "at") == sorted([("a", None, 0), ("a", 1, 1), ("a", 5, 2), ("a", 900, 3), ("b", 7, 0)], key=repr)


def test_align_leaves_gaps_where_bad_rows_were(spark):
    rows = [("e", 0, 2, 0.2), ("e", 1, 0, 0.0), ("e", 2, 2, 9.0), ("e", 3, 1, math.nan), ("e", 4, 3, 0.3), ("e", 5, None, 0.5)]
    df = spark.createDataFrame(rows, "k string, row long, frame_index long, timestamp double")
    done = align.complete(align.dedupe_and_number(df, ["k"], "frame_index", "row"), ["timestamp", "frame_index"], ["timestamp"])
    assert values(done, "frame_index", "timestamp", "row") == [(0, 0.5, 5), (1, 0.0, 1), (3, 0.2, 0), (4, 0.3, 4)]


def test_zscore_null_zero_deviation_and_width(spark):
    df = spark.createDataFrame([([1.0, None, 3.0],)], "v array<float>")
    z = df.select(zscore(F.col("v"), F.array(F.lit(0.0), F.lit(0.0), F.lit(1.0)), F.array(F.lit(2.0), F.lit(1.0), F.lit(0.0))).alias("z")).first()["z"]
    assert z == [0.5, None, 2.0]
    frames = spark.createDataFrame([(1, [0.0] * 8), (2, [0.0] * 7), (3, None)], "i int, v array<float>")
    assert values(align.exact_width(frames, ["v"], 8), "i") == [(1,)]


def test_moments_are_those_of_all_rows(spark):
    random.seed(3)
    groups = [[random.gauss(0, 2) for _ in range(n)] for n in (3, 7, 20)]
    stat = lambda x: (len(x), [sum(x) / len(x)], [math.sqrt(sum((v - sum(x) / len(x)) ** 2 for v in x) / len(x))], [min(x)], [max(x)])
    rows = [("f", *stat(g)) for g in groups] + [("f", 4, [math.nan], [0.0], [0.0], [0.0]), ("f", 4, [0.0, 1.0], [0.0, 0.0], [0.0, 0.0], [0.0, 0.0])]
    df = spark.createDataFrame(rows, "feature string, n long, mean array<double>, std array<double>, min array<double>, max array<double>")
    good, bad = usable(df, ["feature"])
    assert bad.count() == 2
    r, (n, mean, std, low, high) = reduce_moments(good, ["feature"]).first(), stat([v for g in groups for v in g])
    assert (r["count"], r["min"], r["max"]) == (n, low[0], high[0])
    assert math.isclose(r["mean"], mean[0], abs_tol=1e-12) and math.isclose(r["std"], std[0], rel_tol=1e-12)


def test_split_golden_values(spark):
    ids = spark.range(102).toDF("i")
    split = {r["i"]: r["s"] for r in ids.select("i", hashing.split_of(hashing.unit_hash(42)(F.col("i"))).alias("s")).collect()}
    assert [i for i, s in split.items() if s == "val"] == [6, 7, 38, 58, 97, 100]
    assert [i for i, s in split.items() if s == "test"] == [13, 21, 27, 42, 56, 68]
    assert round(hashing.unit_interval(hashing.stable_hash(0, 42)), 6) == 0.099871
    with pytest.raises(ValueError):
        hashing.split_of(F.lit(0.5), 0.8, 0.1, 0.2)
    with pytest.raises(ValueError):
        hashing.stable_hash(1, bits=12)
    none = ids.limit(1).select(F.lit("train").alias("split"))
    assert values(split_counts(none), "split", "episodes") == [("test", 0), ("train", 1), ("val", 0)]


def test_manifest_diff(spark):
    schema = "chunk string, episode_index long, fingerprint string, status string"
    previous = spark.createDataFrame([("0", 1, "a", "NEW"), ("0", 2, "b", "NEW"), ("0", 3, "c", "NEW"), ("0", 4, None, "DELETED"), ("0", 5, "x", "NEW"), ("0", 9, None, "ORPHAN_VIDEO"), ("0", 9, None, "ORPHAN_VIDEO")], schema)
    current = spark.createDataFrame([("0", 1, "a", "NEW"), ("0", 2, "z", "NEW"), ("0", 5, "y", "PENDING"), ("0", 6, "q", "NEW"), ("0", 7, None, "NEW"), ("0", 9, "n", "MISSING_SIDE")], schema)
    got = values(manifest.with_status(current, previous, S.KEY), "episode_index", "status")
    assert got == [(1, "UNCHANGED"), (2, "CHANGED"), (5, "PENDING"), (6, "NEW"), (7, "ERROR"), (9, "MISSING_SIDE")]
    assert values(manifest.deleted(current, previous, S.KEY), "episode_index") == [(3,)]


def test_flexible_json(spark):
    texts = ["3", "[1, 2.5]", "[[1]]", "[]", "x", None, '["4"]']
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(float_list(F.col("t"))).collect()]
    assert got == [[3.0], [1.0, 2.5], None, [], None, None, [4.0]]
    counts = ['{"count": 7}', '{"count": [9, 9]}', '{"frames": 4}', '{"count_total": 2}', "{}", '{"count": "x", "frame_count": 5}']
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(counts)], "i int, t string").orderBy("i").select(frame_count(F.col("t"))).collect()]
    assert got == [7, 9, 4, 2, None, 5]
    lines = ['{"episode_index": 1}', '{"episode": 2}', "a,b,3", " 4 ", "", "[5, 6]", "{broken", '{"other": 9}', "7,"]
    assert values(parse_ids(spark.createDataFrame([(x,) for x in lines], "value string")), "episode_index") == [(1,), (2,), (3,), (4,)]


def test_episode_stats_shapes(spark):
    v = '"mean": [1.0], "std": [0.0], "min": [1.0], "max": [1.0]'
    rows = [(1, {"action": f'{{"count": 3, {v}}}'}), (2, {"action": "{}", "observation.state": f'{{"count": [5], {v}}}'}), (3, {"action": f'{{"count": 0, {v}}}'}), (4, {"action": '{"count": 2, "mean": [1.0], "std": [1.0, 2.0], "min": [0], "max": [0]}'}), (5, None)]
    got = parse_stats(spark.createDataFrame(rows, "episode_index long, stats map<string,string>"), ["action", "observation.state"])
    assert values(got.where("mean is not null"), "episode_index", "feature", "n") == [(1, "action", 3), (2, "observation.state", 5)]
    assert values(got.select("episode_index").distinct(), "episode_index") == [(1,), (2,), (4,)]


def test_names_and_small_functions(spark):
    paths = ["file:/d/data/chunk-000/episode_000012.parquet", "/d/data/chunk-a-7/episode_abc.parquet", "episode_5.mp4", "/x/ep.parquet"]
    got = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, p string").orderBy("i").select(episode_index(F.col("p")), chunk_id(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [(12, "000"), (None, "7"), (5, None), (None, None)]
    one = spark.range(1)
    assert [tuple(r) for r in one.select(rate(F.lit("60/2")), rate(F.lit("3/0")), rate(F.lit("9"))).collect()] == [(30.0, 3.0, None)]
    found = one.select(issues((F.lit(True), "a", F.lit(3)), (F.lit(False), "b", None), (F.lit(None).cast("boolean"), "c", None), (F.lit(True), "d", None)).alias("x")).first()["x"]
    assert [(e["code"], e["detail"]) for e in found] == [("a", "3"), ("d", None)]
    assert comma_list("chunk-000, 003,", "chunk-") == ["000", "003"] and comma_list("") is None
    assert parse_since("2024-05-17T12:34:56Z").timestamp() == 1715949296
    with pytest.raises(ValueError):
        parse_since("yesterday")
    status = one.select(diffed_status(F.lit("b"), F.lit("a"), F.lit(S.PENDING)), diffed_status(F.lit(None), F.lit("a"), F.lit(S.NEW))).first()
    assert tuple(status) == (S.PENDING, S.ERROR)
