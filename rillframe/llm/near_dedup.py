"""Near-duplicate detection by min-max hashing.

A text's set holds its distinct five-word shingles. Under each of ``permutations`` random linear maps both the
smallest and the largest hash of the set are kept, so half as many hashes are evaluated as values are gained; bands
of four values (two maps) are the keys of candidates. Links are confirmed on the full sets, as 64-bit hashes.

1. One pass over the texts stages, per document, its set's size and fingerprint and its band keys; no text moves.
2. Documents with equal sets form a class, which has a number of its own and the text of its smallest id. Copies end here,
   whatever their number. Classes that share an id are linked.
3. In each bucket of a band the member leads whose buckets hold most members: of copies that were each edited
   differently that is the one they come from. Each member is confirmed against the leader that it shares most buckets
   with, so a group of thousands of near copies costs one comparison a member; then, if they are in different
   components, against its other leaders, as many as there are bands at most.
4. Classes that share a bucket with one of another component are then held against each other by an exact prefix filter:
   of two sets that are similar enough, the rarest quarters (by the number of these classes that hold a shingle) have a
   shingle in common. Pairs that meet there are confirmed unless the shingles that only one of them has, their sizes or
   their parities rule the similarity out; and components are found again. So each candidate pair is confirmed, ruled
   out by an exact bound, or linked already, and pairs of one bucket never meet just for being in it.

Minima and counts are combined before shuffles; joins on buckets and sets can be split where they are skewed. Only
texts that some candidate pair names are moved, once. Nothing is gathered on the driver.

Defined cases: a text of one to four words has its whole sequence as its only shingle; null, empty and wordless texts
have no shingles, are linked with nothing and are kept. A null id is never linked: its component_id is null and it is
kept. Rows that repeat an id share its component, also where their texts differ (each has its own size of set); each is
kept or dropped with the id. Equal texts form one component. Ids may be of any type that has an order. Empty tables give
empty results. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillframe.llm.common import staged, unused
from rillframe.llm.components import components
from rillframe.llm.shingles import mix, prepared, shingle_sets


@dataclass(frozen=True)
class Config:
    permutations: int = 80
    rows: int = 4
    percent: int = 75
    seed: int = 1


def min_max(hashes: np.ndarray, a: np.ndarray, b: np.ndarray, block: int = 8192) -> np.ndarray:
    """(permutations, 2): the smallest and largest image of the hashes under each map x -> a * x + b modulo 2**32."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    out = None
    for i in range(0, len(x), block):
        images = a[:, None] * x[None, i : i + block] + b[:, None]
        part = np.stack([images.min(axis=1), images.max(axis=1)], axis=1)
        out = part if out is None else np.stack([np.minimum(out[:, 0], part[:, 0]), np.maximum(out[:, 1], part[:, 1])], axis=1)
    return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    values = signature.reshape(-1, rows).astype(np.uint64)
    key = np.arange(len(values), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(rows):
        key = mix(key ^ (values[:, k] + np.uint64((k + 1) << 40)))
    return key.view(np.int64)


def text_key() -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64("text").alias("text_key")


def sketches(docs: DataFrame, config: Config) -> DataFrame:
    """doc_id, text_key, and of each document's set: size, fingerprint (sums of hashes: equal for equal sets) and band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(config.seed)
        a = rng.integers(0, 1 << 32, config.permutations, dtype=np.uint32) | np.uint32(1)
        b = rng.integers(0, 1 << 32, config.permutations, dtype=np.uint32)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                rows: list[tuple] = []
                for h in shingle_sets([prepared(t) for t in part.column(1).to_pylist()]):
                    if len(h):
                        fp = (int(h.sum(dtype=np.uint64).view(np.int64)), int(mix(h ^ np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64).view(np.int64)))
                        rows.append((len(h), *fp, band_keys(min_max(h, a, b), config.rows)))
                    else:
                        rows.append((0, None, None, np.zeros(0, np.int64)))
                n, fp1, fp2, bands = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(n, pa.int64()), pa.array(fp1, pa.int64()), pa.array(fp2, pa.int64()), pa.array(list(bands), pa.list_(pa.int64()))], names=["doc_id", "text_key", "n_shingles", "fp1", "fp2", "bands"])

    own = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", text_key()).mapInArrow(run, f"doc_id {own}, text_key bigint, n_shingles bigint, fp1 bigint, fp2 bigint, bands array<bigint>")


def confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are similar enough."""
    left, right = (texts.select(F.col("rep").alias(k), F.col("text").alias(f"text_{k}")) for k in "ab")
    rows = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                firsts, seconds = part.column(2).to_pylist(), part.column(3).to_pylist()
                distinct = {t: i for i, t in enumerate(dict.fromkeys([*firsts, *seconds]))}
                sets = list(shingle_sets([prepared(t) for t in distinct]))
                keep = []
                for s, t in zip(firsts, seconds, strict=True):
                    x, y = sets[distinct[s]], sets[distinct[t]]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= percent * (len(x) + len(y) - both) and both > 0)
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(run, "a bigint, b bigint")


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) that aren't in one component yet."""
    x, y = (found.select(F.col("node").alias(k), F.col("root").alias(f"root_{k}")) for k in "ab")
    rows = pairs.join(x, "a", "left").join(y, "b", "left")
    return rows.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b"))


def _linked(pairs: DataFrame, texts: DataFrame, found: DataFrame, config: Config) -> tuple[DataFrame, DataFrame]:
    """The components after those of ``pairs`` that are confirmed are added to ``found``, and the pairs."""
    links = staged(confirm(pairs, texts, config.percent), "links")
    if links.isEmpty():
        return found, pairs
    return components(links.unionByName(found.select(F.col("root").alias("a"), F.col("node").alias("b"))), "a", "b"), pairs


def _rare_shingles(reps: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Of reps (rep, n, root): (h, rep, n, root, fit), the shingles of the prefix filter.

    In the order of rarity, the shingle at place r of n is the first that a set shares with another of m shingles only if
    the n - r + 1 left are enough for the similarity, so only if m <= fit. Shingles that no other set has come first and
    are shared with none, so only the others are gathered by set. A set whose other shingles are too few for any
    partner has no row: many copies of one text, each edited too much to be alike, end here. So do shingles all of whose
    sets are in one component.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = list(shingle_sets([prepared(t) for t in part.column(1).to_pylist()]))
                size = [len(s) for s in sets]
                columns = [np.repeat(part.column(k).to_numpy(), size) for k in (0, 2, 3)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(np.concatenate(sets).view(np.int64))], names=["rep", "n", "root", "h"])

    rows = texts.join(reps, "rep").select("rep", "text", "n", "root").mapInArrow(run, "rep bigint, n bigint, root bigint, h bigint")
    rows = staged(rows, "shingles")
    often = rows.groupBy("h").agg(F.count("*").alias("sets"), F.min("root").alias("low"), F.max("root").alias("high")).where(F.col("sets") > 1)
    shared = rows.join(often.select("h", "sets", (F.col("low") < F.col("high")).alias("mixed")), "h").groupBy("rep", "n", "root").agg(F.sort_array(F.collect_list(F.struct("sets", "h", "mixed"))).alias("shared"))
    placed = shared.select("rep", "n", "root", F.size("shared").alias("others"), F.posexplode("shared").alias("at", "e"))
    fit = F.floor(((100 + percent) * (F.col("others") - F.col("at")) - percent * F.col("n")) / percent)
    placed = placed.where("e.mixed").select(F.col("e.h").alias("h"), "rep", "n", "root", fit.alias("fit"))
    return placed.where(100 * F.col("fit") >= percent * F.col("n"))


BITS = 1024


def _parities(reps: DataFrame, texts: DataFrame) -> DataFrame:
    """(rep, parity): how many of each set's hashes fall on each of BITS places, modulo 2, as 64-bit words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [np.packbits(np.bincount((s % np.uint64(BITS)).astype(np.int64), minlength=BITS).astype(np.uint8) & 1).view(np.int64) for s in shingle_sets([prepared(t) for t in batch.column(1).to_pylist()])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.int64()))], names=["rep", "parity"])

    return texts.join(reps.select("rep"), "rep").select("rep", "text").mapInArrow(run, "rep bigint, parity array<bigint>")


def _possible(prefixes: DataFrame, parities: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that meet in a prefix and can be similar enough.

    The larger set is paired with the smaller, as far as both fit. Places at which the parities of two sets differ are no
    more than elements that only one of them has, so too many of them rule a pair out as well.
    """
    rows = staged(prefixes.join(parities, "rep"), "possible")
    x, y = (rows.where(side).select("h", *[F.col(c).alias(f"{c}_{k}") for c in ("rep", "n", "root", "fit", "parity")]) for k, side in (("x", F.lit(True)), ("y", F.col("fit") >= F.col("n"))))
    total = F.col("n_x") + F.col("n_y")
    fits = (F.col("root_x") != F.col("root_y")) & (F.col("n_y") <= F.col("fit_x")) & (F.col("n_x") <= F.col("fit_y")) & (100 * F.col("n_y") >= percent * F.col("n_x"))
    fits = fits & ((F.col("n_y") < F.col("n_x")) | ((F.col("n_y") == F.col("n_x")) & (F.col("rep_y") < F.col("rep_x"))))
    differ = F.aggregate(F.zip_with("parity_x", "parity_y", lambda i, j: F.bit_count(i.bitwiseXOR(j))), F.lit(0), lambda i, j: i + j)
    fits = fits & (differ <= total - 2 * F.ceil(percent * total / (100 + percent)))
    return x.join(y, "h").where(fits).select(F.least("rep_x", "rep_y").alias("a"), F.greatest("rep_x", "rep_y").alias("b")).distinct()


def near_duplicates(docs: DataFrame, config: Config = Config(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable) and kept (the component's smallest id), per document."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    seen = staged(sketches(docs, config), "sketches")
    fp = ["fp1", "fp2", "n_shingles"]
    classes = seen.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()).groupBy(*fp).agg(F.min("doc_id").alias("first"), F.min_by("text_key", "doc_id").alias("text_key"))
    classes = staged(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")  # written once, so a class's number stays
    known = classes.select(*fp, "rep", "first")
    tagged = seen.select("doc_id", *fp).alias("s").join(known.alias("c"), (F.col("s.fp1") == F.col("c.fp1")) & (F.col("s.fp2") == F.col("c.fp2")) & (F.col("s.n_shingles") == F.col("c.n_shingles")), "left")
    tagged = staged(tagged.select("doc_id", "s.n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("rep")).alias("rep"), "first"), "tagged")
    twins = tagged.where(F.col("rep").isNotNull()).groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where(F.col("a") < F.col("z")).select("doc_id", "a")
    twins = staged(tagged.join(twins, "doc_id").select("a", F.col("rep").alias("b")).where(F.col("a") != F.col("b")).distinct(), "twins")

    bands = classes.select(F.col("first").alias("doc_id"), "fp1", "fp2", "rep").join(seen.select("doc_id", *fp, "bands"), ["doc_id", "fp1", "fp2"]).dropDuplicates(["rep"])
    bands = bands.select("rep", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    shared = bands.groupBy("bucket").agg(F.count("*").alias("size")).where(F.col("size") > 1)
    members = staged(bands.join(shared, "bucket"), "members")
    drawn = members.groupBy("rep").agg(F.sum("size").alias("drawn"))
    leaders = members.select("bucket", "rep").join(drawn, "rep").groupBy("bucket").agg(F.max(F.struct("drawn", (-F.col("rep")).alias("rep"))).alias("best")).select("bucket", (-F.col("best.rep")).alias("leader"))
    members = staged(members.join(leaders, "bucket").select("bucket", "leader", "rep", "n"), "members")
    alike = lambda x, y: (100 * F.least(x, y) >= config.percent * F.greatest(x, y))  # noqa: E731  the least that sizes must allow
    sizes = classes.select("rep", F.col("n_shingles").alias("n"))
    needed = members.select("rep").distinct().join(classes.select("rep", F.col("first").alias("doc_id"), "text_key"), "rep")
    texts = staged(docs.withColumn("text_key", text_key()).join(needed, ["doc_id", "text_key"]).select("rep", "text").dropDuplicates(["rep"]), "texts")

    votes = members.where(F.col("rep") != F.col("leader")).groupBy("rep", "leader", "n").agg(F.count("*").alias("votes"))
    votes = votes.join(sizes.select(F.col("rep").alias("leader"), F.col("n").alias("leader_n")), "leader").where(alike(F.col("n"), F.col("leader_n")))
    votes = staged(votes.select(F.col("leader").alias("a"), F.col("rep").alias("b"), "votes"), "votes")
    first = votes.groupBy("b").agg(F.max(F.struct("votes", (-F.col("a")).alias("a"))).alias("best")).select((-F.col("best.a")).alias("a"), "b")
    found, tried = _linked(staged(first, "pairs"), texts, components(twins, "a", "b"), config)
    second = _apart(votes.select("a", "b").join(tried, ["a", "b"], "left_anti"), found).select("a", "b")
    found, more = _linked(staged(second, "pairs"), texts, found, config)
    tried = tried.unionByName(more)

    labelled = staged(members.join(found, F.col("rep") == F.col("node"), "left").select("bucket", "rep", "n", F.coalesce("root", "rep").alias("root")), "labelled")
    mixed = labelled.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where(F.col("low") < F.col("high")).select("bucket")
    reps = staged(labelled.join(mixed, "bucket").select("rep", "n", "root").distinct(), "reps")
    third = _possible(_rare_shingles(reps, texts, config.percent), _parities(reps, texts), config.percent)
    known = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    joined, _ = _linked(staged(third.join(known, ["a", "b"], "left_anti"), "pairs"), texts, found, config)

    nodes = joined.join(classes.select(F.col("rep").alias("node"), "first"), "node")
    smallest = nodes.groupBy("root").agg(F.min("first").alias("least"))
    nodes = joined.join(smallest, "root").select(F.col("node").alias("rep"), "least")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", F.when(F.col("rep").isNotNull(), F.col("first")), "doc_id"))
    rows = tagged.join(nodes, "rep", "left")
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep(docs: DataFrame, config: Config = Config(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that near_duplicates keeps, with its columns."""
    key = unused(docs, "gone")[0]
    gone = near_duplicates(docs, config, doc_id, text).where(~F.col("kept")).select(F.col("doc_id").alias(key)).distinct()
    return docs.join(gone, F.col(doc_id) == F.col(key), "left_anti")
