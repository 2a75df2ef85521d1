"""WARC: reading and writing records, and resolving not-modified revisits.

``resolve_revisits`` is an as-of join: a revisit record (a server's 304 answer, without a body) refers to the latest
full response of the same canonical URL that was captured strictly earlier. Its validators are held against that
response: entity tags (by weak comparison) if both have one, else Last-Modified if both have one, else payload digests
if both have one. If they agree, or nothing can be compared, the revisit is resolved: headers that a 304 may update
replace the response's. If they disagree it is a mismatch, and is not resolved to an older response.

The join takes no window over all captures of a URL. First all records of one URL and time are one row, with the last of
its responses. These rows are dealt to spans by ranges of (URL, time), cut by Spark's sampled quantiles; the last
response of each (URL, span) is carried to the URL's later spans, and only rows of one span are ordered together. So a
URL that holds a third of all captures is spread over the spans however its times lie, in a burst or with strays far
off, and captures of one moment were summed before. Rows carry headers, never payloads.

Defined cases: a null url has no canonical URL and its revisits are not resolved; a null time is never earlier or
later than another; of responses captured at the same latest time the one with the largest record id counts; repeated
revisits are each resolved; a response at the revisit's own time is not earlier; null validators and headers count as
absent; empty tables give empty results; extra columns are not read.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillframe.llm.common import staged
from rillframe.llm.url_filter import host_of, path_of

# Fields that a 304 answer may carry to update a stored response (RFC 9110, 15.4.5; RFC 9111, 3.2).
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
# Query parameters that only track where a visitor came from.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid|msclkid|mc_cid|mc_eid)(=.*)?$"


def canonical_url(url: Column) -> Column:
    """Host without www. and default port, path without a closing slash, sorted query without tracking parameters.

    Scheme and fragment go. Null for a null url or one without "://".
    """
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.when(F.instr(url, "://") > 0, F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


RECORDS = "record_id bigint, url string, captured_at bigint, kind string, payload_digest string, headers map<string,string>"


def resolve_revisits(records: DataFrame, buckets: int | None = None) -> DataFrame:
    """One row per revisit of RECORDS (kind revisit; full responses are of kind response; captured_at in microseconds;
    header names in lower case): record_id, canonical_url, captured_at, refers_to, status, headers (merged).

    status is resolved, mismatch or missing; refers_to is null for missing, headers for all but resolved. ``buckets``: how
    many spans there are, by default as many as Spark takes for a shuffle.
    """
    rows = staged(records.select("record_id", canonical_url(F.col("url")).alias("canonical_url"), "captured_at", "kind", "payload_digest", F.array_sort(F.map_entries("headers")).alias("headers")), "records")
    full = F.when(F.col("kind") == "response", F.struct("record_id", "payload_digest", "headers"))
    timed = rows.where(F.col("canonical_url").isNotNull() & F.col("captured_at").isNotNull() & F.col("kind").isin("response", "revisit"))
    moments = staged(timed.groupBy("canonical_url", "captured_at").agg(F.max(full).alias("full"), F.bool_or(F.col("kind") == "revisit").alias("asked")), "moments")
    by = [F.col("canonical_url"), F.col("captured_at")]
    dealt = moments.repartitionByRange(buckets, *by) if buckets else moments.repartitionByRange(*by)
    dealt = staged(dealt.withColumn("span", F.spark_partition_id()), "spans")
    per_span = dealt.groupBy("canonical_url", "span").agg(F.max(F.when(F.col("full").isNotNull(), F.struct("captured_at", "full"))).alias("last"))
    earlier = Window.partitionBy("canonical_url").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_span.select("canonical_url", "span", F.max("last").over(earlier).alias("carried"))
    within = Window.partitionBy("canonical_url", "span").orderBy("captured_at").rowsBetween(Window.unboundedPreceding, -1)
    answers = dealt.withColumn("near", F.last("full", ignorenulls=True).over(within)).where("asked").join(carried, ["canonical_url", "span"])
    answers = answers.select("canonical_url", "captured_at", F.coalesce("near", "carried.full").alias("found"))
    revisits = rows.where(F.col("kind") == "revisit")
    joined = revisits.join(answers, ["canonical_url", "captured_at"], "left")

    own, stored = F.map_from_entries("headers"), F.map_from_entries("found.headers")
    value = lambda m, k: F.try_element_at(m, F.lit(k))
    agree = F.coalesce(
        weak(value(own, "etag")) == weak(value(stored, "etag")),
        value(own, "last-modified") == value(stored, "last-modified"),
        F.col("payload_digest") == F.col("found.payload_digest"),
        F.lit(True),
    )
    status = F.when(F.col("found").isNull(), "missing").when(agree, "resolved").otherwise("mismatch")
    updates = F.filter(F.coalesce("headers", F.array().cast("array<struct<key:string,value:string>>")), lambda e: e["key"].isin(PERMITTED) & e["value"].isNotNull())
    names = F.transform(updates, lambda e: e["key"])
    kept = F.filter(F.coalesce("found.headers", F.array().cast("array<struct<key:string,value:string>>")), lambda e: ~F.array_contains(names, e["key"]))
    merged = F.map_from_entries(F.array_sort(F.concat(kept, updates)))
    return joined.select("record_id", "canonical_url", "captured_at", F.col("found.record_id").alias("refers_to"), status.alias("status"), F.when(status == "resolved", merged).alias("headers"))


def attach_payloads(resolved: DataFrame, payloads: DataFrame) -> DataFrame:
    """``resolved`` with the payload of the response that each resolved revisit refers to; payloads: (record_id, payload)."""
    rows = payloads.select(F.col("record_id").alias("refers_to"), "payload")
    hit = resolved.withColumn("refers_to", F.when(F.col("status") == "resolved", F.col("refers_to")))
    return resolved.join(hit.select("record_id", "refers_to").dropDuplicates().join(rows, "refers_to").select("record_id", "payload"), "record_id", "left")


def write_record(kind: str, url: str, date: str, http: dict[str, str], payload: bytes = b"", status: str = "200 OK", extra: dict[str, str] | None = None, compressed: bool = True) -> bytes:
    """A WARC 1.1 record with an HTTP head; as a gzip member of its own if compressed."""
    head = f"HTTP/1.1 {status}\r\n" + "".join(f"{k}: {v}\r\n" for k, v in http.items()) + "\r\n"
    block = head.encode() + payload
    fields = {"WARC-Type": kind, "WARC-Target-URI": url, "WARC-Date": date, "Content-Type": "application/http; msgtype=response", **(extra or {}), "Content-Length": str(len(block))}
    record = ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n").encode() + block + b"\r\n\r\n"
    return gzip.compress(record, mtime=0) if compressed else record


def _head(stream: io.BufferedIOBase) -> dict[str, str]:
    fields: dict[str, str] = {}
    last = None
    while line := stream.readline():
        line = line.rstrip(b"\r\n").decode("utf-8", "replace")
        if not line:
            break
        if line[0] in " \t" and last:
            fields[last] += " " + line.strip()
        elif ":" in line:
            last, value = line.split(":", 1)
            last = last.strip().lower()
            fields[last] = value.strip()
    return fields


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], str, dict[str, str], bytes]]:
    """(WARC fields, HTTP status line, HTTP fields, payload) of each record; compressed or not. Stops at a broken record."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data))
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            return
        fields = _head(stream)
        length = fields.get("content-length", "")
        if not length.isdigit():
            return
        block = io.BufferedReader(io.BytesIO(stream.read(int(length))))
        if not fields.get("content-type", "").startswith("application/http"):
            yield fields, "", {}, block.read()
            continue
        first = block.readline().rstrip(b"\r\n").decode("utf-8", "replace")
        yield fields, first, _head(block), block.read()


WARC_SCHEMA = "path string, position bigint, kind string, url string, date string, status string, headers map<string,string>, warc_fields map<string,string>, payload binary"


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the WARC files under a path; a task holds one file (2 GB at most) at a time."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name = batch.column(0)[i].as_py()
                for at, (fields, status, http, payload) in enumerate(parse_warc(batch.column(1)[i].as_py())):
                    row = [name, at, fields.get("warc-type"), fields.get("warc-target-uri"), fields.get("warc-date"), status, list(http.items()), list(fields.items()), payload]
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _TYPES, strict=True)], names=_NAMES)

    return files.mapInArrow(run, WARC_SCHEMA)


_TEXTS = pa.map_(pa.string(), pa.string())
_NAMES = ["path", "position", "kind", "url", "date", "status", "headers", "warc_fields", "payload"]
_TYPES = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), _TEXTS, _TEXTS, pa.binary()]
