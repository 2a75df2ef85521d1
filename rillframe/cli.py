"""Command line: discover, validate, stats, align-transform and materialize."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from rillframe import schemas as S
from rillframe import sinks
from rillframe.functions.expressions import comma_list, parse_since
from rillframe.plans import steps

COLUMNS = ["chunk", "episode_index", "status", "parquet_uri"]


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="rillframe", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)
    p = commands.add_parser("discover", help="refresh the manifest and print what changed")
    p.add_argument("--data-root", required=True)
    p.add_argument("--manifest", default="./output/manifest/episodes.parquet")
    p.add_argument("--workers", type=int, default=16, help="accepted for compatibility; Spark's tasks do the work")
    p.add_argument("--since", type=parse_since, help="ISO 8601 time of the oldest files to look at")
    p.add_argument("--stdout", action="store_true", help="print JSON lines with all columns")
    p.add_argument("--full-hash", action="store_true")
    p.add_argument("--only-chunks", help="comma-separated, with or without chunk-")
    p.add_argument("--all", action="store_true", help="print the whole manifest")
    p = commands.add_parser("validate", help="validate what the manifest says is new")
    p.add_argument("--manifest", default="./output/manifest/episodes.parquet")
    p.add_argument("--meta-dir", required=True)
    p.add_argument("--out", default="./output/validate")
    p.add_argument("--fps", type=float, default=30.0)
    p.add_argument("--tolerance", type=int, default=2)
    p.add_argument("--skip-video", action="store_true")
    p = commands.add_parser("stats", help="reduce per-episode statistics")
    p.add_argument("--data-root", default=".")
    p.add_argument("--episodes-stats", required=True)
    p.add_argument("--validated-ids")
    p.add_argument("--features", default=",".join(S.VECTORS))
    p.add_argument("--out", default="./output/global_stats.json")
    p = commands.add_parser("align-transform", help="clean and normalize episodes")
    p.add_argument("--data-root", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--stats")
    p.add_argument("--no-normalize", action="store_true")
    p = commands.add_parser("materialize", help="write the split dataset")
    p.add_argument("--norm-dir", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--seed", type=int, default=42)
    for name, share in (("train", 0.8), ("val", 0.1), ("test", 0.1)):
        p.add_argument(f"--{name}", type=float, default=share)
    p.add_argument("--videos-root")
    p.add_argument("--views", default=",".join(S.VIEWS))
    p.add_argument("--video-source-chunk-id", help="take videos of this chunk instead of each episode's own")
    p.add_argument("--link-videos", choices=sinks.LINKS, default="symlink")
    return top


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(arguments)
    spark = spark or SparkSession.builder.appName(f"rillframe {a.command}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command == "discover":
        found = steps.discover(spark, a.data_root, a.manifest, a.since, comma_list(a.only_chunks, "chunk-"), a.full_hash)
        if a.all:
            found = spark.read.schema(S.MANIFEST).parquet(a.manifest)
        if a.stdout and not a.all:
            for line in sinks.json_rows(found):
                sys.stdout.write(line + "\n")
        else:
            for row in found.select(*COLUMNS).orderBy("chunk", "episode_index").toLocalIterator():
                print(*row, sep="\t")
    elif a.command == "validate":
        print(steps.run_validate(spark, a.manifest, a.meta_dir, a.out, a.fps, a.tolerance, a.skip_video))
    elif a.command == "stats":
        rows, meta = steps.global_stats(spark, a.episodes_stats, comma_list(a.features) or list(S.VECTORS), a.validated_ids)
        sinks.write_json(spark, sinks.stats_json(rows, meta), a.out)
        print(json.dumps(meta))
    elif a.command == "align-transform":
        steps.run_align(spark, a.data_root, a.out, a.stats, not a.no_normalize)
    else:
        print(json.dumps(steps.run_materialize(spark, a.norm_dir, a.out, a.seed, a.train, a.val, a.test, a.videos_root, tuple(comma_list(a.views) or S.VIEWS), a.video_source_chunk_id, a.link_videos)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
