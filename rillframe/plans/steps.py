"""The five steps. Each reads what the one before has written; all episodes of a step are one plan."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillframe import schemas as S
from rillframe import sinks
from rillframe.functions.expressions import chunk_id, episode_index, initial_status, issues, utc_now, videos_root
from rillframe.functions.hashing import SPLITS, check_fractions, split_of, unit_hash
from rillframe.operators import align, manifest
from rillframe.operators.moments import reduce_moments, usable
from rillframe.operators.ordered import ordering_summary
from rillframe.sources import jsonl
from rillframe.sources.files import EpisodeFiles, list_files, matches, normalized_episodes
from rillframe.sources.workers import ffprobe, fingerprints, footers, probes


def _conform(df: DataFrame, schema: str) -> DataFrame:
    fields = df.sparkSession.createDataFrame([], schema).schema
    have = set(df.columns)
    return df.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


# ---- discover


def current_manifest(spark: SparkSession, root: str, since: datetime | None = None, only_chunks: list[str] | None = None, full_hash: bool = False) -> tuple[DataFrame, DataFrame]:
    """(manifest rows of the episodes there are, videos)."""
    files = EpisodeFiles(spark, root)
    parquets, videos = files.parquets(since, only_chunks), files.videos(only_chunks)
    now = F.lit(utc_now())
    sides = videos.groupBy(*S.KEY).pivot("view", list(S.VIEWS)).agg(F.max("path"))
    sides = sides.select(*S.KEY, *[F.col(f"`{v}`").alias(n) for v, n in zip(S.VIEWS, ("video_front_uri", "video_wrist_uri"), strict=True)])
    named = parquets.where(F.col("episode_index").isNotNull()).withColumnRenamed("path", "parquet_uri").join(sides, S.KEY, "left")
    rows = fingerprints(named, full_hash).withColumns({"exists_front": F.col("video_front_uri").isNotNull(), "exists_wrist": F.col("video_wrist_uri").isNotNull()})
    rows = rows.withColumn("status", F.when(F.col("fingerprint").isNull(), S.ERROR).otherwise(initial_status(F.col("unstable"), F.col("exists_front") & F.col("exists_wrist"))))
    bad = parquets.where(F.col("episode_index").isNull()).select(F.lit(-1).alias("episode_index"), "chunk", F.col("path").alias("parquet_uri"), F.lit(False).alias("exists_front"), F.lit(False).alias("exists_wrist"), F.lit(0).alias("bytes_total"), F.lit(S.ERROR).alias("status"), F.to_json(F.struct(F.lit("bad_episode_name").alias("reason"))).alias("errors"))
    both = [_conform(x.withColumns({"fingerprint_algo": F.lit(S.FINGERPRINT_ALGO), "discovered_at": now}), S.MANIFEST) for x in (rows, bad)]
    return both[0].unionByName(both[1]), videos


def diff_manifest(current: DataFrame, videos: DataFrame, previous: DataFrame | None, carried: DataFrame | None = None) -> DataFrame:
    """The new manifest: current rows with their status, deleted keys, orphan videos, and rows out of scope as they were."""
    stamp = {"fingerprint_algo": F.lit(S.FINGERPRINT_ALGO), "discovered_at": F.lit(utc_now())}
    absent = {"exists_front": F.lit(False), "exists_wrist": F.lit(False), "bytes_total": F.lit(0)}
    parts = [current if previous is None else manifest.with_status(current, previous, S.KEY)]
    if previous is not None:
        parts.append(_conform(manifest.deleted(current, previous, S.KEY).withColumns(absent | stamp | {"status": F.lit(S.DELETED)}), S.MANIFEST))
    lost = manifest.orphans(videos, current, S.KEY)
    front = F.col("view") == S.VIEWS[0]
    sides = {"video_front_uri": F.when(front, F.col("path")), "video_wrist_uri": F.when(~front, F.col("path")), "exists_front": front, "exists_wrist": ~front, "bytes_total": F.col("length"), "status": F.lit(S.ORPHAN_VIDEO)}
    parts.append(_conform(lost.withColumns(sides | stamp), S.MANIFEST))
    parts += [carried] if carried is not None else []
    return reduce(DataFrame.unionByName, parts)


def discover(spark: SparkSession, root: str, manifest_path: str, since: datetime | None = None, only_chunks: list[str] | None = None, full_hash: bool = False) -> DataFrame:
    """Write the manifest and return its delta.

    With ``only_chunks`` or ``since`` only what is in scope is compared; other rows are carried over unchanged, so
    a narrow run reports nothing as deleted that it didn't look for.
    """
    current, videos = current_manifest(spark, root, since, only_chunks, full_hash)
    previous = spark.read.schema(S.MANIFEST).parquet(manifest_path) if matches(spark, sinks.recovered(spark, manifest_path)) else None
    carried = None
    if previous is not None:
        inside = F.lit(True) if only_chunks is None else F.col("chunk").isin(only_chunks)
        if since is not None:  # files that are too old to be looked at again
            all_keys = EpisodeFiles(spark, root).parquets(None, only_chunks).select(*S.KEY)
            skipped = all_keys.join(current.select(*S.KEY), S.KEY, "left_anti").distinct().withColumn("_skipped", F.lit(True))
            marked = previous.join(skipped, S.KEY, "left")
            inside = inside & F.col("_skipped").isNull()
            videos = videos.join(skipped.drop("_skipped"), S.KEY, "left_anti")
        else:
            marked = previous
        kept = F.col("status") != S.DELETED
        carried = marked.where(~inside & kept).select(*previous.columns)
        previous = marked.where(inside).select(*previous.columns)
    elif since is not None:
        videos = videos.join(EpisodeFiles(spark, root).parquets(None, only_chunks).select(*S.KEY), S.KEY, "left_anti")
    sinks.replace_table(diff_manifest(current, videos, previous, carried).orderBy(*S.KEY), manifest_path)
    return manifest.delta(spark.read.schema(S.MANIFEST).parquet(manifest_path))


# ---- validate


def episode_summary(frames: DataFrame, keys: list[str], order: str) -> DataFrame:
    """What the rules need, per episode. frames: the required columns, keys and the order column."""
    any_null = reduce(Column.__or__, [F.col(f"`{c}`").isNull() for c in S.REQUIRED])
    width = lambda c: F.size(F.col(f"`{c}`"))
    aggregates = [
        F.count("*").alias("n_rows"), F.min("frame_index").alias("min_frame"), F.max("frame_index").alias("max_frame"), F.bool_or(any_null).alias("any_null"),
        F.max(width("action")).alias("max_action"), F.max(width("observation.state")).alias("max_state"), F.min(width("action")).alias("min_action"), F.min(width("observation.state")).alias("min_state"),
    ]
    return ordering_summary(frames, keys, order, strict=["frame_index"], ascending=["timestamp"], ends=["episode_index"], aggregates=aggregates)


def judged(rows: DataFrame, tolerance: int, fps: float, views: dict[str, str] | None) -> DataFrame:
    """issues and ok of joined findings. views: the prefix of each view's columns (path, nb_frames, fps) by its short name."""
    text = lambda c: F.col(c).cast("string")
    read = F.col("schema_error").isNull() & F.col("missing").isNull()
    some = read & F.coalesce(F.col("n_rows") > 0, F.lit(False))
    index = F.col("episode_index")
    ends_differ = ~(F.col("episode_index_first").eqNullSafe(index) & F.col("episode_index_last").eqNullSafe(index))
    wide = lambda c: F.coalesce(F.col(c), F.lit(-1)) != S.WIDTH
    off = lambda a, b: F.coalesce(F.abs(a - b) > tolerance, F.lit(False))
    rules = [
        (F.col("parquet_uri").isNull(), "parquet_missing", None),
        (F.col("parquet_uri").isNotNull() & F.col("schema_error").isNotNull(), "schema_error", F.col("schema_error")),
        (F.col("missing").isNotNull(), "missing_columns", F.to_json("missing")),
        (F.col("parquet_uri").isNotNull() & read & ~some, "empty_episode", None),
        (some & ~F.col("min_frame").eqNullSafe(F.lit(0)), "frame_index_start", text("min_frame")),
        (some & ~F.col("frame_index_sorted"), "frame_index_not_sorted", None),
        (some & ~F.col("timestamp_sorted"), "timestamp_not_sorted", None),
        (some & F.col("any_null"), "nulls_in_required_columns", None),
        (some & ends_differ, "episode_index_mismatch", F.to_json(F.array("episode_index_first", "episode_index_last", "episode_index"))),
        (some & wide("max_action"), "action_width", text("max_action")),
        (some & wide("max_state"), "state_width", text("max_state")),
        (some & off(F.col("expected_rows_meta"), F.col("n_rows")), "rows_vs_meta", F.to_json(F.struct(F.col("expected_rows_meta").alias("meta"), F.col("n_rows").alias("table")))),
    ]
    for name, p in (views or {}).items():
        path, frames, rate = F.col(f"{p}_path"), F.col(f"{p}_nb_frames"), F.col(f"{p}_fps")
        probed = F.col(f"{p}_probed")
        rules += [
            (some & ~probed, f"{name}_video_missing", path),
            (some & probed & F.coalesce((rate != 0) & (F.abs(rate - fps) > 1.0), F.lit(False)), f"{name}_fps", rate),
            (some & probed & off(frames, F.col("n_rows")), f"{name}_frames_vs_rows", F.to_json(F.struct(frames.alias("video"), F.col("n_rows").alias("table")))),
        ]
    return rows.withColumn("issues", issues(*rules)).withColumn("ok", F.size("issues") == 0)


def read_frames(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The required columns of episode files with file (path) and row (place within the file)."""
    schema = spark.createDataFrame([], S.FRAMES).schema
    if not paths:
        return spark.createDataFrame([], schema).selectExpr("*", "cast(null as string) as file", "cast(null as bigint) as row")
    return spark.read.schema(schema).parquet(*paths).select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def validate(spark: SparkSession, episodes: DataFrame, meta_path: str | None = None, fps: float = 30.0, tolerance: int = 2, skip_video: bool = False, probe: Callable[[str], dict | None] = ffprobe) -> DataFrame:
    """VALIDATION rows of manifest rows. Footers are read first: only files with all columns, readable, are scanned."""
    rows = episodes.select(*S.KEY, "parquet_uri", "video_front_uri", "video_wrist_uri")
    there = rows.where(F.col("parquet_uri").isNotNull()).select(F.col("parquet_uri").alias("path")).distinct()
    lacking = F.array_except(F.array(*[F.lit(c) for c in S.REQUIRED]), "columns")
    heads = footers(there).select(F.col("path").alias("parquet_uri"), F.col("error").alias("schema_error"), F.when(F.size(lacking) > 0, lacking).alias("missing"))
    heads = heads.checkpoint() if spark.sparkContext._jsc.sc().getCheckpointDir().isDefined() else heads.cache()
    good = [r["parquet_uri"] for r in heads.where(F.col("schema_error").isNull() & F.col("missing").isNull()).select("parquet_uri").toLocalIterator()]
    found = episode_summary(read_frames(spark, good), ["file"], "row").withColumnRenamed("file", "parquet_uri")
    meta = jsonl.episodes_meta(spark, meta_path) if meta_path else spark.createDataFrame([], "episode_index bigint, length bigint")
    rows = rows.join(heads, "parquet_uri", "left").join(found.withColumn("parquet_uri", _same_uri("parquet_uri")), "parquet_uri", "left")
    rows = rows.join(meta.withColumnRenamed("length", "expected_rows_meta"), "episode_index", "left")
    views = None
    if not skip_video:
        views = {"front": "front", "wrist": "wrist"}
        root = videos_root(F.col("video_front_uri"), F.col("video_wrist_uri"), F.col("parquet_uri"), F.col("chunk"))
        for name, view, known in zip(views, S.VIEWS, ("video_front_uri", "video_wrist_uri"), strict=True):
            uri = f"{name}_uri"  # where the manifest has the video, else where it belongs
            rows = rows.withColumn(uri, F.coalesce(F.col(known), F.concat(root, F.format_string(f"/{view}/episode_%06d.mp4", "episode_index"))))
            seen = probes(rows.where(F.col(uri).isNotNull()).select(F.col(uri).alias("path")).distinct(), probe)
            rate = F.coalesce(F.when(F.col("avg_fps") != 0, F.col("avg_fps")), "r_fps")
            seen = seen.select(F.col("path").alias(uri), F.col("nb_frames").alias(f"{name}_nb_frames"), rate.alias(f"{name}_fps"), F.lit(True).alias(f"{name}_hit")).dropDuplicates([uri])
            rows = rows.join(seen, uri, "left").withColumns({f"{name}_probed": F.coalesce(f"{name}_hit", F.lit(False)), f"{name}_path": F.col(uri)})
    done = judged(rows, tolerance, fps, views).withColumnsRenamed({"n_rows": "rows", "min_frame": "frame_min", "max_frame": "frame_max"})
    return _conform(done, S.VALIDATION)


def _same_uri(column: str) -> Column:
    """Spark's listing and its _metadata may write a local path with one or three slashes."""
    return F.regexp_replace(column, "^file:/+", "file:/")


def run_validate(spark: SparkSession, manifest_path: str, meta_dir: str, out_dir: str, fps: float = 30.0, tolerance: int = 2, skip_video: bool = False, probe: Callable[[str], dict | None] = ffprobe) -> dict[str, int]:
    """Validate actionable episodes and merge the results by key into those of earlier runs."""
    episodes = manifest.actionable(spark.read.schema(S.MANIFEST).parquet(manifest_path))
    results = validate(spark, episodes, f"{meta_dir}/episodes.jsonl", fps, tolerance, skip_video, probe)
    table = sinks.recovered(spark, f"{out_dir}/episodes.parquet")
    if matches(spark, table):
        gone = spark.read.schema(S.MANIFEST).parquet(manifest_path).where(F.col("status") == S.DELETED).select(*S.KEY)
        earlier = spark.read.schema(S.VALIDATION).parquet(table).join(episodes.select(*S.KEY), S.KEY, "left_anti").join(gone, S.KEY, "left_anti")
        results = results.unionByName(earlier.select(*results.columns))
    sinks.replace_table(results, table)
    results = spark.read.schema(S.VALIDATION).parquet(table)
    sinks.write_json_lines(results.where(~F.col("ok")), f"{out_dir}/failures.jsonl")
    sinks.write_json_lines(results.where("ok").select("episode_index", "rows", "chunk", "parquet_uri", "video_front_uri", "video_wrist_uri"), f"{out_dir}/validated_episodes.jsonl")
    summary = results.agg(F.count("*").alias("total"), F.count_if("ok").alias("ok"), F.count_if(~F.col("ok")).alias("fail"))
    return sinks.write_summary(summary, f"{out_dir}/summary.yaml")


# ---- stats


def global_stats(spark: SparkSession, stats_path: str, features: list[str], ids_path: str | None = None) -> tuple[DataFrame, dict]:
    """(a row per feature and dimension, meta). Records with NaN or another width than their feature's are left out and counted."""
    rows = jsonl.episode_stats(spark, stats_path, features)
    ids = jsonl.valid_ids(spark, ids_path)
    if ids is not None:
        rows = rows.join(ids, "episode_index", "left_semi")
    rows = rows.cache()
    used = rows.where(F.col("feature") == features[0]).agg(F.count("*").alias("e"), F.coalesce(F.sum("n"), F.lit(0)).alias("f")).first()
    good, bad = usable(rows.where(F.col("mean").isNotNull() & F.col("std").isNotNull() & F.col("min").isNotNull() & F.col("max").isNotNull()), ["feature"])
    meta = {"episodes_used": used["e"], "total_frames": used["f"], "source": stats_path, "features": features, "records_left_out": bad.count(), "note": "Frame-weighted reduction of per-episode statistics."}
    return reduce_moments(good, ["feature"]), meta


# ---- align and transform


def align_frames(frames: DataFrame, keys: list[str], tie: str, stats: dict | None = None, validated: DataFrame | None = None) -> DataFrame:
    """Cleaned frames with keys. Numbering comes before bad rows go, so their numbers stay unused."""
    rows = frames if validated is None else frames.join(validated, "episode_index", "left_semi")  # Spark broadcasts the ids where they are few
    types = {"timestamp": "double", **dict.fromkeys(("frame_index", "episode_index", "index", "task_index"), "bigint"), **dict.fromkeys(S.VECTORS, "array<float>")}
    rows = align.exact_width(align.cast_to(rows, types), list(S.VECTORS), S.WIDTH)
    rows = align.dedupe_and_number(rows, keys, "frame_index", tie).drop(tie)
    rows = align.complete(rows, ["timestamp", "frame_index", "episode_index"], ["timestamp"])
    if stats:
        literal = lambda v: F.array(*[F.lit(float(x)) for x in v])
        rows = align.normalize(rows, {c: (literal(stats[c]["mean"]), literal(stats[c]["std"])) for c in S.VECTORS}, S.WIDTH)
    return rows


def run_align(spark: SparkSession, data_root: str, out: str, stats_path: str | None = None, normalize: bool = True, validated: DataFrame | None = None) -> None:
    """Write chunk=/episode_index= partitions. Asked for normalization without usable statistics, it raises."""
    stats = None
    if normalize and stats_path:
        stats = jsonl.read_json(spark, stats_path)
        if not stats or any(not stats.get(c, {}).get(k) for c in S.VECTORS for k in ("mean", "std")):
            raise ValueError(f"no usable statistics in {stats_path}; pass normalize=False to go without")
    frames = read_frames(spark, normalized_episodes(spark, data_root))
    frames = frames.withColumns({"chunk": F.coalesce(chunk_id(F.col("file")), F.lit("000")), "file_episode": episode_index(F.col("file"))}).drop("file")
    rows = align_frames(frames, ["chunk", "file_episode"], "row", stats, validated)
    own = rows.repartition("chunk", "file_episode").sortWithinPartitions("chunk", "file_episode", "frame_index")
    sinks.replace_table(own, out, ["chunk", "file_episode"])


# ---- materialize


def assign_splits(episodes: DataFrame, seed: int = 42, train: float = 0.8, val: float = 0.1, test: float = 0.1) -> DataFrame:
    """Distinct keys with their split, by the keyed hash of the episode index."""
    check_fractions(train, val, test)
    return episodes.withColumn("split", split_of(unit_hash(seed)(F.col("episode_index")), train, val, test))


def dataset_index(frames: DataFrame, videos: DataFrame | None = None, views: tuple[str, ...] = S.VIEWS) -> DataFrame:
    """A row per episode: its split, path and rows, and the path of each view's video or null."""
    rows = frames.groupBy("episode_index", "split", "chunk").agg(F.count("*").alias("num_rows"))
    base = F.format_string("split=%s/chunk=%s", "split", "chunk")
    rows = rows.withColumn("parquet_path", F.concat(base, F.format_string("/episode_index=%d", "episode_index")))
    for view in views:
        if videos is None:
            rows = rows.withColumn(f"{view}.path", F.lit(None).cast("string"))
            continue
        own = videos.where(F.col("view") == view).select(*S.KEY, F.lit(True).alias("_has")).dropDuplicates(S.KEY)
        rows = rows.join(own, S.KEY, "left").withColumn(f"{view}.path", F.when(F.col("_has"), F.concat(base, F.format_string(f"/videos/{view}/episode_%06d.mp4", "episode_index")))).drop("_has")
    return rows.select("episode_index", "split", "chunk", "parquet_path", *[F.col(f"`{v}.path`") for v in views], "num_rows")


def split_counts(index: DataFrame) -> DataFrame:
    """Episodes by split; a split without any counts 0."""
    every = index.sparkSession.createDataFrame([(s,) for s in SPLITS], "split string")
    return every.join(index.groupBy("split").agg(F.count("*").alias("n")), "split", "left").select("split", F.coalesce("n", F.lit(0)).alias("episodes"))


def run_materialize(spark: SparkSession, norm_dir: str, out: str, seed: int = 42, train: float = 0.8, val: float = 0.1, test: float = 0.1, videos_root: str | None = None, views: tuple[str, ...] = S.VIEWS, video_chunk: str | None = None, link_videos: str = "symlink") -> dict:
    """Write split=/chunk=/episode_index= partitions, the index and a manifest; link videos, of each episode's own chunk by default."""
    schema = spark.createDataFrame([], S.ALIGNED + ", chunk string, file_episode bigint").schema
    if not matches(spark, f"{norm_dir}/chunk=*/file_episode=*/*.parquet"):
        raise FileNotFoundError(f"no episodes under {norm_dir}")
    frames = spark.read.schema(schema).parquet(norm_dir)
    episodes = assign_splits(frames.select("chunk", F.col("file_episode").alias("episode_index")).distinct(), seed, train, val, test)
    rows = frames.drop("episode_index").withColumnRenamed("file_episode", "episode_index").join(episodes, S.KEY)
    sinks.replace_table(rows.repartition("split", *S.KEY).sortWithinPartitions("split", *S.KEY, "frame_index"), f"{out}/data", ["split", "chunk", "episode_index"])
    videos = None
    if videos_root:
        found = list_files(spark, f"{videos_root}/chunk-{video_chunk or '*'}/*/episode_*.mp4")
        videos = found.select(chunk_id(F.col("path")).alias("chunk"), episode_index(F.col("path")).alias("episode_index"), F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("view"), "path")
        if video_chunk:
            videos = videos.drop("chunk").join(episodes.select("chunk", "episode_index"), "episode_index")
    index = dataset_index(rows.select("episode_index", "split", "chunk"), videos, views).withColumn("parquet_path", F.concat(F.lit("data/"), "parquet_path"))
    sinks.replace_table(index, f"{out}/dataset_index.parquet")
    index = spark.read.parquet(f"{out}/dataset_index.parquet")
    if videos is not None:
        targets = videos.join(episodes, S.KEY).where(F.col("view").isin(*views))
        sinks.link_all(targets.select(F.col("path").alias("source"), F.format_string(f"{out}/split=%s/chunk=%s/videos/%s/episode_%06d.mp4", "split", "chunk", "view", "episode_index").alias("target")), link_videos)
    done = {"source_parquet": norm_dir, "source_videos": videos_root, "output": out, "seed": seed, "fractions": {"train": train, "val": val, "test": test}, "counts": {r["split"]: r["episodes"] for r in split_counts(index).collect()}, "views": list(views), "link_videos": link_videos}
    sinks.write_json(spark, done, f"{out}/_manifest.json")
    return done
