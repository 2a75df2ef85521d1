"""Best-fit packing of token sequences by the sum-of-squares rule.

A document is its token ids and an end id. Documents longer than a sequence are cut; then pieces are packed: each goes
where the sum, over residual gaps, of the squared counts of open sequences becomes smallest; a new sequence is opened
only where no open one has room, as sequences should be few. A piece that takes a bin of gap g to gap r changes that sum by
2 * (count[r] - count[g]) + 2, where full bins count nothing; so the rule needs the counts alone. Within a group pieces
come longest first, ties by the number that a row gets when it is staged.

Tokenizing is one pass over the texts that leaves a row of some tens of bytes per piece, staged; a long text is encoded in
parts, cut where no token can cross. Those rows are dealt
by the hash of their numbers, so repeated rows are spread like others, to groups of about ``group_tokens`` tokens or ``group_pieces`` pieces, which
are packed independently, whichever of them share a task: what is held at once is one group's numbers, never texts, and
a group leaves a few sequences unfilled at most, however large the input is.

Defined cases: a null or empty text is the end id alone; no row is dropped, repeated rows are packed each for itself; a
document of 2048 tokens is one full sequence, a longer one is cut so that its first piece takes the remainder; rows
with a null id are packed like others; ids may be of any type; an empty table gives an empty result; extra columns are
not read.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillframe.llm.common import staged

SPECIAL = "<|endoftext|>"  # the vocabulary's special token, which follows its ranks
# A unit is white space and what follows it up to the next white space. The vocabulary's words hold white space alone, or
# one space as their first character, so no word crosses the border of two units. (1C to 1F aren't white space to it.)
UNIT = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")


@dataclass(frozen=True)
class Config:
    """``ranks``: the byte-level BPE vocabulary as base64 tokens with ranks, of which ``pattern`` cuts the words.

    ``part_chars``: about how much of a text is encoded at once.
    """

    ranks: str
    pattern: str
    capacity: int = 2048
    end_id: int = 0
    group_tokens: int = 12_000_000
    group_pieces: int = 500_000
    part_chars: int = 1 << 20


def public_config(**changes: int) -> Config:
    """The public 50k byte-level vocabulary. Its two files hold the same ids; this one's library encodes faster."""
    import public_tokenizers

    return Config(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, **changes)


@lru_cache(maxsize=2)
def encoder(ranks: str, pattern: str):
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=table, special_tokens={SPECIAL: len(table)})


def parts(text: str, most: int) -> Iterator[str]:
    """A text in parts of about ``most`` characters, cut at borders of units."""
    at = 0
    while len(text) - at > most:
        edge = UNIT.search(text, at + most).end()  # of the unit, or of what is left of it
        yield text[at:edge]
        at = edge
    yield text[at:]


def ids(text: str | None, config: Config) -> Iterator[np.ndarray]:
    """A text's ids, an array for each part."""
    encode = encoder(config.ranks, config.pattern).encode
    return (np.array(encode(part, allowed_special="all"), "<u4") for part in parts(text or "", config.part_chars))


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: only a document longer than a sequence is cut, into full ones after the first."""
    first = length % capacity or capacity
    return [(0, min(first, length))] + [(start, capacity) for start in range(first, length, capacity)] if length > capacity else [(0, length)]


PIECES = "piece int, start bigint, length bigint, ids_crc32 bigint"
NAMES = ["piece", "start", "length", "ids_crc32"]
TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]


def pieces(docs: DataFrame, config: Config, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and PIECES of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([config.end_id], "<u4")
        for batch in batches:
            owner: list[int] = []
            out: list[tuple] = []
            for i, value in enumerate(batch.column(1)):
                own = np.concatenate([*ids(value.as_py(), config), end])
                made = cut(len(own), config.capacity)
                owner += [i] * len(made)
                out += [(k, start, n, zlib.crc32(own[start : start + n])) for k, (start, n) in enumerate(made)]
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, TYPES, strict=True)]], names=["doc_id", *NAMES])

    own = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string")).mapInArrow(run, f"doc_id {own}, {PIECES}")


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, in the order given. Among equal changes the fullest bin wins."""
    counts = np.zeros(capacity + 1, np.int64)  # open bins by gap; counts[0] stays 0: full bins count nothing
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    place, offset, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i, n in enumerate(lengths.tolist()):
        gap = capacity
        if n < capacity:
            after, before = counts[: capacity - n], counts[n:capacity]  # gaps n .. capacity-1 become 0 .. capacity-1-n
            change = 2 * (after - before) + 2
            change[0] -= 1  # a filled bin no longer counts
            change[before == 0] = 1 << 60
            k = int(change.argmin())
            if change[k] < 1 << 60:
                gap = n + k
        if gap == capacity:
            at, made = made, made + 1
        else:
            at = stacks[gap].pop()
            counts[gap] -= 1
        place[i], offset[i] = at, capacity - gap
        if gap > n:
            stacks[gap - n].append(at)
            counts[gap - n] += 1
    return place, offset


def pack(rows: DataFrame, config: Config) -> DataFrame:
    """``pieces`` rows, of which each has a number in column row, with sequence_id and offset."""
    total, n = rows.agg(F.sum("length"), F.count("*")).first()
    groups = max(1, -(-(total or 0) // config.group_tokens), -(-n // config.group_pieces))
    dealt = rows.withColumn("group", F.pmod(F.xxhash64("row", F.lit("group")), F.lit(groups)).cast("int"))

    def run(group: pa.Table) -> pa.Table:
        number = group.column("group")[0].as_py()
        group = group.sort_by([("length", "descending"), ("row", "ascending")])
        place, offset = sum_of_squares(group.column("length").to_numpy(), config.capacity)
        return group.select(["doc_id", *NAMES]).append_column("sequence_id", pa.array(place + (number << 40))).append_column("offset", pa.array(offset))

    own = rows.schema["doc_id"].dataType.simpleString()
    return dealt.groupBy("group").applyInArrow(run, f"doc_id {own}, {PIECES}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, config: Config | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    config = config or public_config()
    return pack(staged(pieces(docs, config, doc_id, text).withColumn("row", F.monotonically_increasing_id()), "pieces"), config)
