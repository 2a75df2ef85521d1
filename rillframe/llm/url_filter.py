"""URL filters: host and path rules, and a Bloom filter cascade for exact membership, in native expressions only.

The cascade encodes which keys of a finite universe are listed. Level 0 is a Bloom filter of the listed keys; level 1
one of the unlisted keys that level 0 lets through; level 2 one of the listed keys that level 1 lets through; and so
on until a level lets nothing wrong through. A key of the universe is listed if the number of levels that it passes
in a row is odd. That is exact for each key of the universe the cascade was built over, so the universe is the
corpus's complete set of keys: every host with each of its parent domains, and every address (host and path).

The filters go to the executors as binary constants of the plan; no row is joined. Their size is known before they are
gathered: keys are dealt by hash to as many shards as keep a shard's first filter below ``max_level_bits``, each shard has a
cascade of its own, and a key is looked up in its shard's. The shards of one pass over the rows have ``pass_bits``
together; with more, passes follow each other, each written before the next. So the method is the same at every size, and
what is sent at once is bounded.

Defined cases: a null url, or one without "://", has an empty host and path and no key, so no rule fits and nothing
is listed; a host without a dot is its own only key; an address is listed as "host/path" and matches that path only; null
and empty listed keys list nothing, repeated ones count once; empty tables give empty results; equal rows get equal
verdicts; extra columns pass through, and clashing ones keep their names (made ones get leading underscores).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillframe.llm.common import let, staged, unused

# The alphabets of ASCII lower-casing.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first "://", up to "/", "?", "#" or the end, with A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to "?", "#" or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def parents(host: Column) -> Column:
    """A host and its parent domains, longest first; none for an empty host."""
    labels = F.split(host, r"\.")
    return F.when(F.length(host) == 0, F.array().cast("array<string>")).otherwise(let(labels, lambda x: F.transform(F.sequence(F.lit(1), F.size(x)), lambda i: F.array_join(F.slice(x, i, F.size(x) - i + 1), "."))))


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def rule_fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def by_rules(rules: list[Rule], host: Column, path: Column, what: str) -> Column:
    """The name or verdict of the longest rule that fits (of equally long ones the first in order); null if none does."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        found = F.when(rule_fits(rule, host, path), F.lit(getattr(rule, what))).otherwise(found)
    return found


@dataclass(frozen=True)
class Level:
    """A Bloom filter: bit i is bit i % 8 of byte i // 8 of ``table``."""

    bits: int
    hashes: int
    seed: int
    table: bytes

    def holds(self, key: Column) -> Column:
        table = F.lit(bytearray(self.table))

        def bit(at: Column) -> Column:
            byte = F.conv(F.hex(F.substring(table, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            return F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1

        return F.forall(F.array(*places(key, self.bits, self.hashes, self.seed)), bit)


def places(key: Column, bits: int, hashes: int, seed: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed * 64 + k)), F.lit(bits).cast("bigint")) for k in range(hashes)]


def hashes_of(rate: float) -> int:
    return max(1, round(-log(rate, 2)))


def level_bits(n_keys: int, rate: float) -> int:
    return 64 * ceil(n_keys * hashes_of(rate) / log(2) / 64)


def make_level(keys: DataFrame, column: str, expected: int, rate: float, seed: int) -> tuple[Level, int]:
    """A filter of ``keys``, about ``expected`` of them, that lets about ``rate`` of other keys through, and how many keys it holds.

    What reaches the driver is its bits.
    """
    hashes, bits = hashes_of(rate), level_bits(max(1, expected), rate)
    at = keys.select(F.explode(F.array(*places(F.col(column), bits, hashes, seed))).alias("at"))
    mask = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("at") % 64).cast("int")))
    words = at.groupBy(F.shiftright("at", 6).cast("int").alias("word")).agg(mask.alias("mask"), F.count("*").alias("n"))
    table, n = bytearray(bits // 8), 0
    for word, mask, count in words.toLocalIterator(prefetchPartitions=True) if expected > 1 << 16 else words.collect():  # as many words as keys at most
        table[8 * word : 8 * word + 8] = (mask % (1 << 64)).to_bytes(8, "little")
        n += count
    return Level(bits, hashes, seed, bytes(table)), n // hashes


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    @property
    def bits(self) -> int:
        return sum(level.bits for level in self.levels)

    def lists(self, key: Column) -> Column:
        """Whether a key of the universe is listed: the first level that stops it has an odd place (0-based)."""
        verdict = F.lit(len(self.levels) % 2 == 1)
        for i, level in reversed(list(enumerate(self.levels))):
            verdict = F.when(~level.holds(key), F.lit(i % 2 == 1)).otherwise(verdict)
        return verdict


def marked_keys(listed: DataFrame, universe: DataFrame, column: str = "key") -> DataFrame:
    """The distinct keys of ``universe``, staged, with is_listed; ``listed`` counts only where it is in ``universe``."""
    keys = universe.join(listed.select(column, F.lit(True).alias("is_listed")), column, "left").select(column, F.coalesce("is_listed", F.lit(False)).alias("is_listed"))
    return staged(keys.where(F.col(column).isNotNull()), "universe")


LATER_RATE = 1 / 64


def first_rate(n_in: int, n_out: int) -> float:
    """The first level lets through about half as many unlisted keys as there are listed ones."""
    return min(0.5, max(1e-6, n_in / max(1, n_out) / 2))


def _cascade(keys: DataFrame, column: str, n_in: int, n_out: int, max_levels: int = 60) -> Cascade:
    """One job for each level: how many keys it has to hold is expected from the rate before, and counted as it is made."""
    levels: list[Level] = []
    left, here, there = keys, n_in, n_out  # keys that this level encodes, and those that it should stop
    while here:
        if len(levels) >= max_levels:
            raise ValueError("the cascade doesn't end; are keys repeated?")
        rate = LATER_RATE if levels else first_rate(n_in, n_out)
        side = F.col("is_listed") == F.lit(len(levels) % 2 == 0)
        level, held = make_level(left.where(side), column, here, rate, len(levels))
        if not held:
            break
        levels.append(level)
        left = left.where(side | level.holds(F.col(column)))  # what this level encodes, and what it lets through wrongly
        here, there = (ceil(there * rate) + 8 if there else 0), held
    return Cascade(tuple(levels))


def _sizes(keys: DataFrame) -> tuple[int, int]:
    listed, n = keys.agg(F.count_if("is_listed"), F.count("*")).first()
    return listed, n - listed


def build_cascade(listed: DataFrame, universe: DataFrame, column: str = "key") -> Cascade:
    """One cascade over distinct keys."""
    keys = marked_keys(listed, universe, column)
    return _cascade(keys, column, *_sizes(keys))


SHARD = 1 << 20  # seed of the hash that deals keys to shards


def shard_of(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(SHARD)), F.lit(shards))


def build_shards(listed: DataFrame, universe: DataFrame, column: str = "key", max_level_bits: int = 1 << 23) -> Iterator[tuple[int, int, Cascade]]:
    """(shards, shard, its cascade), one after the other."""
    keys = marked_keys(listed, universe, column)
    n_in, n_out = _sizes(keys)
    shards = max(1, ceil(level_bits(n_in, first_rate(n_in, n_out)) / max_level_bits)) if n_in else 1
    for k in range(shards):
        part = keys if shards == 1 else keys.where(shard_of(F.col(column), shards) == k)
        yield shards, k, _cascade(part, column, *(_sizes(part) if shards > 1 else (n_in, n_out)))


def _in_shard(shards: int, shard: int, cascade: Cascade) -> Callable[[Column], Column]:
    return lambda key: (shard_of(key, shards) == shard) & cascade.lists(key)


def filter_urls(pages: DataFrame, rules: list[Rule], listed: DataFrame, url: str = "url", max_level_bits: int = 1 << 23, pass_bits: int = 1 << 26) -> DataFrame:
    """``pages`` with host, path, rule and verdict: the longest fitting rule's, else block if the host, a parent or the address is listed.

    ``listed`` has a column host: a domain, which lists its subdomains too, or an address with its path.
    """
    host, path, rule, verdict, keys, hit = unused(pages, "host", "path", "rule", "verdict", "keys", "hit")
    rows = pages.withColumns({host: host_of(F.col(url)), path: path_of(F.col(url))})
    seen = pages.select(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")).distinct()
    universe = seen.select("host").distinct().select(F.explode(parents(F.col("host"))).alias("key")).distinct()
    universe = universe.unionByName(seen.where((F.col("host") != "") & (F.col("path") != "")).select(F.concat("host", "path").alias("key")))  # a domain has no slash, so all are distinct
    own = F.regexp_extract("host", "^[^/]*", 0)
    wanted = listed.select(F.concat(F.translate(own, UPPER, LOWER), F.regexp_extract("host", "(?s)/.*$", 0)).alias("key")).where(F.col("key") != "").distinct()
    columns = [F.col(f"`{c}`") for c in [*pages.columns, host, path]]
    address = F.when((F.col(host) != "") & (F.col(path) != ""), F.array(F.concat(F.col(host), F.col(path)))).otherwise(F.array().cast("array<string>"))
    rows = rows.select(*columns, F.concat(parents(F.col(host)), address).alias(keys))
    found, sent = F.lit(False), 0
    for shards, k, cascade in build_shards(wanted, universe, max_level_bits=max_level_bits):
        if sent and sent + cascade.bits > pass_bits:
            rows = staged(rows.select(*columns, F.col(f"`{keys}`"), found.alias(hit)), "pass")
            found, sent = F.col(hit), 0
        sent += cascade.bits
        if cascade.levels:
            found = found | F.exists(F.col(keys), cascade.lists if shards == 1 else _in_shard(shards, k, cascade))
    given = by_rules(rules, F.col(host), F.col(path), "verdict")
    return rows.select(*columns, by_rules(rules, F.col(host), F.col(path), "name").alias(rule), F.coalesce(given, F.when(found, "block").otherwise("allow")).alias(verdict))
