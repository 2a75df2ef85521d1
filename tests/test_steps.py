"""The five steps on synthetic episodes."""

import json
import math
import os
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rillframe import schemas as S
from rillframe import sinks
from rillframe.cli import main
from rillframe.plans import steps
from rillframe.sources.workers import ffprobe, fingerprint, unstable
from rillframe.streaming.trigger import on_new_episodes


def table(n=5, episode=0, width=8, frames=None, stamps=None, **columns):
    made = {
        "action": pa.array([[float(i)] * width for i in range(n)], pa.list_(pa.float32())), "observation.state": pa.array([[float(-i)] * width for i in range(n)], pa.list_(pa.float32(), width)),
        "timestamp": pa.array(stamps or [i / 30 for i in range(n)], pa.float32()), "frame_index": pa.array(frames or list(range(n)), pa.int64()),
        "episode_index": pa.array([episode] * n, pa.int64()), "index": pa.array(list(range(n)), pa.int64()), "task_index": pa.array([0] * n, pa.int64()),
    }
    made |= columns
    return pa.table({k: v for k, v in made.items() if v is not None})


def write(root, chunk, name, data, views=("front", "wrist")):
    path = root / "data" / f"chunk-{chunk}" / f"{name}.parquet"
    path.parent.mkdir(parents=True, exist_ok=True)
    if isinstance(data, bytes):
        path.write_bytes(data)
    else:
        pq.write_table(data, path)
    for v in views:
        video = root / "videos" / f"chunk-{chunk}" / f"observation.images.{v}" / f"{name}.mp4"
        video.parent.mkdir(parents=True, exist_ok=True)
        video.write_bytes(name.encode())
    return path


@pytest.fixture
def dataset(tmp_path):
    root = tmp_path / "set"
    write(root, "000", "episode_000000", table())
    write(root, "000", "episode_000001", table(episode=1, frames=[0, 2, 1, 3, 4]))
    write(root, "000", "episode_000002", table(episode=2, stamps=[0.0, 0.2, 0.1, 0.3, 0.4]))
    write(root, "000", "episode_000003", table(episode=3, frames=[1, 2, 3, 4, 5]))
    late = pa.array([0, 1, None, 3, 4], pa.int64())
    write(root, "000", "episode_000004", table(episode=4, index=late))
    write(root, "000", "episode_000005", table(episode=5, width=7))
    write(root, "000", "episode_000006", table(episode=9))
    write(root, "000", "episode_000007", table(episode=7, task_index=None))
    write(root, "000", "episode_000008", b"junk")
    write(root, "000", "episode_000009", table(n=0, episode=9))
    write(root, "000", "episode_000010", table(episode=10, frame_index=pa.array(list("abcde"))))
    write(root, "000", "episode_000011", table(episode=11), views=("front",))
    write(root, "000", "episode_abc", table(), views=())
    write(root, "001", "episode_000000", table(n=4))
    orphan = root / "videos/chunk-000/observation.images.wrist/episode_000099.mp4"
    orphan.write_bytes(b"v")
    meta = [{"episode_index": i, "tasks": ["t"], "length": n} for i, n in ((0, 7), (1, 8), (2, 5), (11, 5))]
    (root / "meta").mkdir()
    (root / "meta/episodes.jsonl").write_text("\n".join(map(json.dumps, meta)))
    return root


def statuses(df):
    return {(r["chunk"], r["episode_index"]): r["status"] for r in df.collect()}


def test_discover_three_runs(spark, dataset, tmp_path):
    out = str(tmp_path / "manifest.parquet")
    first = statuses(steps.discover(spark, str(dataset), out))
    assert first["000", 0] == S.NEW and first["000", 11] == S.MISSING_SIDE and first["000", -1] == S.ERROR and first["000", 99] == S.ORPHAN_VIDEO and len(first) == 15
    again = statuses(steps.discover(spark, str(dataset), out))
    assert set(again) == {("000", -1), ("000", 99)}
    time.sleep(0.02)
    write(dataset, "000", "episode_000001", table(n=6, episode=1))
    os.remove(dataset / "data/chunk-000/episode_000002.parquet")
    write(dataset, "001", "episode_000005", table(episode=5))
    third = statuses(steps.discover(spark, str(dataset), out, only_chunks=["000"]))
    assert third["000", 1] == S.CHANGED and third["000", 2] in (S.DELETED, S.ORPHAN_VIDEO) and ("001", 0) not in {k for k, v in third.items() if v == S.DELETED} and ("001", 5) not in third
    fourth = statuses(steps.discover(spark, str(dataset), out))
    assert fourth["001", 5] == S.NEW and S.DELETED not in fourth.values()


def test_validate_finds_each_fault(spark, dataset, tmp_path):
    manifest, out = str(tmp_path / "m.parquet"), str(tmp_path / "v")
    steps.discover(spark, str(dataset), manifest)
    probe = lambda path: None if "wrist" in path and "000002" in path else {"nb_frames": 5, "r_fps": 30.0, "avg_fps": 20.0 if "front" in path and "000003" in path else 30.0}
    summary = steps.run_validate(spark, manifest, str(dataset / "meta"), out, probe=probe)
    rows = {(r["chunk"], r["episode_index"], r["parquet_uri"] is None): {i["code"] for i in r["issues"]} for r in spark.read.schema(S.VALIDATION).parquet(f"{out}/episodes.parquet").collect()}
    at = lambda e, chunk="000": rows[chunk, e, False]
    assert at(0) == set() and at(0, "001") == {"rows_vs_meta"}
    assert at(1) == {"frame_index_not_sorted", "rows_vs_meta"} and at(2) == {"timestamp_not_sorted", "wrist_video_missing"}
    assert at(3) == {"frame_index_start", "front_fps"} and at(4) == {"nulls_in_required_columns"} and at(5) == {"action_width", "state_width"}
    assert at(6) == {"episode_index_mismatch"} and at(7) == {"missing_columns"} and at(8) == {"schema_error"} and at(9) == {"empty_episode"} and at(10) == {"schema_error"}
    assert at(11) == {"wrist_video_missing"} and rows["000", 99, True] == {"parquet_missing"}
    assert summary["ok"] == 1 and summary["total"] == len(rows) and summary["fail"] == len(rows) - 1
    assert open(f"{out}/summary.yaml").read() == "total: 15\nok: 1\nfail: 14\n"
    steps.discover(spark, str(dataset), manifest)
    kept = steps.run_validate(spark, manifest, str(dataset / "meta"), out, skip_video=True)
    assert kept["ok"] == 1 and kept["total"] == 15  # a run without changes keeps the results


def test_stats_align_materialize(spark, tmp_path):
    root = tmp_path / "set"
    for i in range(4):
        write(root, "000", f"episode_{i:06d}", table(episode=i, frames=[0, 1, 1, 2, 3]))
    write(root, "001", "episode_000001", table(episode=1, stamps=[0.0, math.nan, 0.1, 0.2, 0.3]))
    stat = lambda x: {"count": [5], "mean": [x] * 8, "std": [2.0] * 7 + [0.0], "min": [0.0] * 8, "max": [4.0] * 8}
    lines = [{"episode_index": i, "stats": {"action": stat(float(i)), "observation.state": stat(0.0), "image": {"mean": [[[0.1]]]}}} for i in range(4)]
    (tmp_path / "stats.jsonl").write_text("\n\n".join(map(json.dumps, lines)))
    (tmp_path / "ids.csv").write_text("x,0\n{\"episode_index\": 2}\nbad\n")
    out = str(tmp_path / "global.json")
    assert main(["stats", "--episodes-stats", str(tmp_path / "stats.jsonl"), "--validated-ids", str(tmp_path / "ids.csv"), "--out", out], spark) == 0
    found = json.load(open(out))
    assert found["meta"]["episodes_used"] == 2 and found["meta"]["total_frames"] == 10 and found["action"]["mean"] == [1.0] * 8 and found["action"]["count"] == 10
    assert math.isclose(found["action"]["std"][0], math.sqrt(5)) and math.isclose(found["action"]["std"][7], 1.0)
    norm = str(tmp_path / "norm")
    main(["align-transform", "--data-root", str(root / "data"), "--out", norm, "--stats", out], spark)
    rows = spark.read.schema(S.ALIGNED + ", chunk string, file_episode bigint").parquet(norm)
    own = sorted((r["frame_index"], r["action"][0]) for r in rows.where("chunk = '000' and file_episode = 0").collect())
    assert [f for f, _ in own] == [0, 1, 2, 3] and math.isclose(own[0][1], -1 / math.sqrt(5), rel_tol=1e-6) and math.isclose(own[2][1], 2 / math.sqrt(5), rel_tol=1e-6)
    assert sorted(r["frame_index"] for r in rows.where("chunk = '001'").collect()) == [0, 2, 3, 4]
    with pytest.raises(ValueError):
        steps.run_align(spark, str(root / "data"), norm, str(tmp_path / "none.json"))
    done = str(tmp_path / "out")
    main(["materialize", "--norm-dir", norm, "--out", done, "--videos-root", str(root / "videos")], spark)
    index = {(r["chunk"], r["episode_index"]): r for r in spark.read.parquet(f"{done}/dataset_index.parquet").collect()}
    assert len(index) == 5 and index["000", 0]["num_rows"] == 4 and {r["split"] for r in index.values()} == {"train"}
    video = os.path.join(done, index["001", 1]["observation.images.front.path"])
    assert os.path.islink(video) and open(video, "rb").read() == b"episode_000001"
    assert json.load(open(f"{done}/_manifest.json"))["counts"] == {"train": 5, "val": 0, "test": 0}
    assert os.path.isdir(os.path.join(done, index["000", 0]["parquet_path"]))


def test_fingerprint_samples_and_sinks(spark, tmp_path):
    path = tmp_path / "f.bin"
    path.write_bytes(b"a" * 10 + b"b" * 10)
    whole, part = fingerprint(str(path), full=True), fingerprint(str(path), sample=5)
    assert whole["size"] == 20 and whole["sha"] != part["sha"] and fingerprint(str(path), sample=20)["sha"] == whole["sha"]
    assert unstable([str(path), str(path) + ".gone"], least=0, pause=0) == {str(path) + ".gone"}
    target = str(tmp_path / "t.parquet")
    sinks.replace_table(spark.range(3).toDF("x"), target)
    sinks.replace_table(spark.read.parquet(target).withColumn("x", F.col("x") + 1), target)
    assert sorted(r["x"] for r in spark.read.parquet(target).collect()) == [1, 2, 3]
    for method in ("hardlink", "copy", "symlink"):
        sinks.link(str(path), str(tmp_path / "links" / method), method)
        assert (tmp_path / "links" / method).read_bytes() == path.read_bytes()
    sinks.link(str(path), str(tmp_path / "links/none"), "manifest-only")
    assert not (tmp_path / "links/none").exists()
    with pytest.raises(ValueError):
        sinks.link(str(path), str(tmp_path / "x"), "teleport")
    assert list(sinks.json_rows(spark.createDataFrame([(1, None)], "a int, b string"))) == ['{"a": 1, "b": null}']


def test_trigger_sees_new_files_once(spark, tmp_path):
    root, seen = tmp_path / "set", []
    write(root, "000", "episode_000000", table(), views=())
    for _ in range(2):
        on_new_episodes(spark, str(root), str(tmp_path / "cp"), lambda df, i: seen.extend(r["path"] for r in df.collect())).awaitTermination()
    write(root, "000", "episode_000001", table(), views=())
    on_new_episodes(spark, str(root), str(tmp_path / "cp"), lambda df, i: seen.extend(r["path"] for r in df.collect())).awaitTermination()
    assert [os.path.basename(p) for p in seen] == ["episode_000000.parquet", "episode_000001.parquet"]


def test_replacement_that_is_broken_off_keeps_a_table(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t.parquet")
    sinks.replace_table(spark.range(3), target)
    real, calls = sinks._move, []

    def failing(session, source, to):
        calls.append(source)
        if ".tmp-" in source:
            raise OSError("no")
        real(session, source, to)

    monkeypatch.setattr(sinks, "_move", failing)
    with pytest.raises(OSError):
        sinks.replace_table(spark.range(5), target)
    assert spark.read.parquet(target).count() == 3 and len(calls) == 3
    monkeypatch.undo()
    os.rename(target, target + sinks.ASIDE)  # as after a crash between the two moves
    assert spark.read.parquet(sinks.recovered(spark, target)).count() == 3
    sinks.replace_table(spark.range(7), target)
    assert spark.read.parquet(target).count() == 7 and sorted(p for p in os.listdir(tmp_path) if not p.endswith(".crc")) == ["t.parquet"] + [p for p in os.listdir(tmp_path) if ".tmp-" in p]


def test_videos_are_looked_for_where_they_belong(spark, tmp_path):
    root = tmp_path / "set"
    write(root, "000", "episode_000000", table())
    write(root, "000", "episode_000001", table(episode=1), views=())
    rows = spark.createDataFrame([("000", e, f"file:{root}/data/chunk-000/episode_{e:06d}.parquet", None, None) for e in (0, 1)], "chunk string, episode_index bigint, parquet_uri string, video_front_uri string, video_wrist_uri string")
    seen = {"nb_frames": "5", "r_fps": "60/2", "avg_fps": "0/0", "duration": None}
    found = {r["episode_index"]: {i["code"]: i["detail"] for i in r["issues"]} for r in steps.validate(spark, rows, probe=lambda path: seen).collect()}
    assert found[0] == {} and set(found[1]) == {"front_video_missing", "wrist_video_missing"}
    assert found[1]["front_video_missing"].endswith("/set/videos/chunk-000/observation.images.front/episode_000001.mp4")


def test_ffprobe_reads_what_the_program_says(tmp_path, monkeypatch):
    program = tmp_path / "ffprobe"
    program.write_text('#!/bin/sh\ncase "$*" in *bad*) exit 1;; esac\nprintf "r_frame_rate=30/1\\navg_frame_rate=2997/100\\nduration=N/A\\nnb_frames=12\\n"\n')
    program.chmod(0o755)
    monkeypatch.setenv("PATH", f"{tmp_path}:{os.environ['PATH']}")
    assert ffprobe("file:/x.mp4") == {"nb_frames": "12", "r_fps": "30/1", "avg_fps": "2997/100", "duration": "N/A"}
    assert ffprobe("/bad.mp4") is None
    monkeypatch.setenv("PATH", "/nowhere")
    assert ffprobe("/x.mp4") is None


def test_discover_and_validate_by_command_line(spark, dataset, tmp_path, capsys):
    out, checked = str(tmp_path / "m.parquet"), str(tmp_path / "v")
    assert main(["discover", "--data-root", str(dataset), "--manifest", out, "--stdout"], spark) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert len(lines) == 15 and len(lines[0]) == 13
    assert main(["discover", "--data-root", str(dataset), "--manifest", out, "--only-chunks", "chunk-001", "--all"], spark) == 0
    assert len([x for x in capsys.readouterr().out.splitlines() if "\t" in x]) == 15
    assert main(["validate", "--manifest", out, "--meta-dir", str(dataset / "meta"), "--out", checked, "--skip-video", "--tolerance", "2"], spark) == 0
    assert "'total': 14" in capsys.readouterr().out.replace('"', "'")


def test_materialize_without_episodes_raises(spark, tmp_path):
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        steps.run_materialize(spark, str(tmp_path / "none"), str(tmp_path / "out"))
