"""Scalar expressions."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from rillframe import schemas as S


def episode_index(path: Column) -> Column:
    """The number after the last underscore of a file's stem; null if it isn't one."""
    return F.regexp_extract(path, r"(?:^|[/_])([+-]?\d+)\.[^./]*$", 1).try_cast("bigint")


def chunk_id(path: Column) -> Column:
    """The text after the last dash of the directory chunk-...; null without one."""
    found = F.regexp_extract(path, r"/chunk-(?:[^/]*-)?([^/-]+)/", 1)
    return F.when(found != "", found)


def video_path(root: str, chunk: Column, view: str, episode: Column) -> Column:
    return F.format_string(f"{root}/videos/chunk-%s/{view}/episode_%06d.mp4", chunk, episode)


def videos_root(front: Column, wrist: Column, parquet: Column, chunk: Column) -> Column:
    """The folder of a chunk's videos: two folders above a video, else beside the data folder of the episode's file."""
    above = lambda path, levels: F.regexp_replace(path, f"(/[^/]+){{{levels}}}$", "")
    return F.coalesce(above(front, 2), above(wrist, 2), F.concat(above(parquet, 3), F.lit("/videos/chunk-"), chunk))


def utc_now() -> str:
    return datetime.now(timezone.utc).isoformat().replace("+00:00", "Z")


def parse_since(text: str) -> datetime:
    try:
        found = datetime.fromisoformat(text.replace("Z", "+00:00"))
    except ValueError as error:
        raise ValueError(f"not an ISO 8601 time: {text!r}") from error
    return found if found.tzinfo else found.astimezone()


def comma_list(text: str | None, prefix: str = "") -> list[str] | None:
    """The items of a comma-separated option, without a prefix; None for an empty option."""
    items = [x.strip().removeprefix(prefix) for x in (text or "").split(",") if x.strip()]
    return items or None


def initial_status(unstable: Column, complete: Column) -> Column:
    return F.when(unstable, S.PENDING).when(~complete, S.MISSING_SIDE).otherwise(S.NEW)


def diffed_status(fingerprint: Column, previous: Column, status: Column) -> Column:
    """ERROR without a fingerprint; UNCHANGED if it is the previous one; a new one of a known episode is CHANGED."""
    return F.when(fingerprint.isNull(), S.ERROR).when(fingerprint == previous, S.UNCHANGED).when(previous.isNotNull() & (status == S.NEW), S.CHANGED).otherwise(status)


def zscore(vector: Column, mean: Column, std: Column) -> Column:
    """(v - mean) / std per dimension in doubles, stored as float; a deviation of 0 counts as 1, a null element stays null."""

    def of(x: Column, i: Column) -> Column:
        sd = F.get(std, i)
        return ((x.cast("double") - F.get(mean, i)) / F.when(sd == 0, 1.0).otherwise(sd)).cast("float")

    return F.transform(vector, of)


def arm(vector: Column) -> Column:
    return F.slice(vector, *S.ARM)


def gripper(vector: Column) -> Column:
    return F.slice(vector, *S.GRIPPER)


def float_list(text: Column) -> Column:
    """A JSON number or list of numbers as array<double>; null for anything else, nested lists included."""
    whole = F.from_json(text, "array<string>")
    parsed = F.transform(whole, lambda x: x.try_cast("double"))
    listed = F.when(F.size(whole) == 0, F.array().cast("array<double>")).when(F.forall(parsed, lambda x: x.isNotNull()), parsed)
    return F.when(F.ltrim(text).startswith("["), listed).otherwise(F.when(text.try_cast("double").isNotNull(), F.array(text.try_cast("double"))))


def frame_count(stats: Column) -> Column:
    """From a feature's JSON: count as a number, its first element, or one of three other names."""
    name = lambda k: F.get_json_object(stats, f"$.{k}")
    whole = lambda c: c.try_cast("double").cast("bigint")
    return F.coalesce(whole(name("count")), whole(name("count[0]")), *[whole(name(k)) for k in ("frame_count", "frames", "count_total")])


def rate(text: Column) -> Column:
    """n/d as a double; d = 0 counts as 1; null without a slash."""
    parts = F.split(text, "/")
    d = F.get(parts, F.lit(1)).try_cast("double")
    return F.when(F.size(parts) == 2, F.get(parts, F.lit(0)).try_cast("double") / F.when(d == 0, 1.0).otherwise(d))


def issues(*rules: tuple[Column, str, Column | None]) -> Column:
    """The rules that hold, in order, as (code, detail)."""
    none = F.lit(None).cast("string")
    made = [F.when(hit, F.struct(F.lit(code).alias("code"), (none if detail is None else detail.cast("string")).alias("detail"))) for hit, code, detail in rules]
    return F.filter(F.array(*made), lambda e: e.isNotNull())


def rounded(value: Column, digits: int = 6) -> Column:
    """Rounded, without a negative zero."""
    return F.round(value, digits) + F.lit(0.0)
