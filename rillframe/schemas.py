"""Schemas and constants of episode datasets."""

from __future__ import annotations

# Names and limits of the dataset format.
VIEWS = ("observation.images.front", "observation.images.wrist")
REQUIRED = ("action", "observation.state", "timestamp", "frame_index", "episode_index", "index", "task_index")
VECTORS = ("action", "observation.state")
WIDTH = 8
ARM, GRIPPER = (1, 7), (8, 1)  # 1-based start and length within a vector
SAMPLE_BYTES = 65_536
STABLE_FROM_BYTES = 50 * 1024 * 1024
STABLE_PAUSE_S = 0.15
FINGERPRINT_ALGO = "size+mtime+sha(head|tail)-v1"

# The states of an episode in the manifest.
NEW, CHANGED, UNCHANGED, MISSING_SIDE = "NEW", "CHANGED", "UNCHANGED", "MISSING_SIDE"
DELETED, ORPHAN_VIDEO, PENDING, ERROR = "DELETED", "ORPHAN_VIDEO", "PENDING", "ERROR"
DELTA = (NEW, CHANGED, MISSING_SIDE, DELETED, ORPHAN_VIDEO, PENDING, ERROR)
ACTIONABLE = (NEW, CHANGED, MISSING_SIDE, PENDING, ERROR, ORPHAN_VIDEO)

KEY = ["chunk", "episode_index"]
FRAMES = "`action` array<float>, `observation.state` array<float>, `timestamp` float, frame_index bigint, episode_index bigint, `index` bigint, task_index bigint"
ALIGNED = FRAMES.replace("`timestamp` float", "`timestamp` double")
MANIFEST = (
    "episode_index bigint, chunk string, parquet_uri string, video_front_uri string, video_wrist_uri string, exists_front boolean, exists_wrist boolean,"
    " bytes_total bigint, fingerprint string, fingerprint_algo string, discovered_at string, status string, errors string"
)
ISSUES = "array<struct<code:string,detail:string>>"
VALIDATION = (
    "episode_index bigint, rows bigint, frame_min bigint, frame_max bigint, expected_rows_meta bigint, ok boolean,"
    f" issues {ISSUES}, chunk string, parquet_uri string, video_front_uri string, video_wrist_uri string"
)
EPISODES_META = "episode_index bigint, tasks array<string>, length bigint"
PROBES = "path string, nb_frames bigint, r_fps double, avg_fps double, duration double"
FOOTERS = "path string, columns array<string>, num_rows bigint, error string"
