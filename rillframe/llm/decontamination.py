"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are normalised: lower-cased, and each run of characters that are neither letters nor digits
becomes one space. An item of n characters may differ by k = floor(``error_rate`` * n) edits. It is split into k + 1
pieces; a passage within k edits holds one of them unchanged. All pieces of a block of items are found in one pass
over a text (Aho-Corasick). Where an item lies unchanged around a hit its distance is 0; the other places are gathered
over the texts of a batch and verified together by Myers' bit-parallel distance, on columns of 64-bit words.

Texts are read once and not shuffled. Items go to the executors in blocks of about ``block_chars`` characters, and a worker
holds the automata of ``held`` blocks and builds the others again for each batch of texts; so what it holds is bounded
however many items there are, and what is broadcast is ``pass_chars`` characters. Only beyond that (64 million
characters of items) the texts are read again, once for each such part of the items.

Items of fewer than ``min_chars`` characters when normalised have no budget: they match where a text holds them unchanged
and whole, between the borders of words. Scripts without spaces have a border at each character.

Defined cases: items that are null or empty match nothing, nor do such short ones of a single word: it can't be told
from ordinary prose; null and empty texts hold nothing; equal items are reported each under its id;
repeated rows are reported each; ids may be of any type; a text that holds an item more than once is reported once, with the least distance
and the first place of it; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

GAP = re.compile(r"[\W_]+")
# Fixed value: characters of scripts without spaces (Thai to Khmer, kana, Han): each is taken for a word.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")


@dataclass(frozen=True)
class Config:
    error_rate: float = 0.06
    min_chars: int = 32
    block_chars: int = 1_000_000
    held: int = 4
    pass_chars: int = 64_000_000


def normalised(text: str) -> str:
    return GAP.sub(" ", text.lower()).strip()


def is_one_word(item: str) -> bool:
    return len(UNSPACED.sub(" x ", item).split()) <= 1


def at_borders(text: str, start: int, end: int) -> bool:
    """Whether a passage of a normalised text begins and ends at borders of words."""
    inside = lambda at: 0 < at < len(text) and " " not in text[at - 1 : at + 1] and not UNSPACED.search(text, at - 1, at + 1)
    return not inside(start) and not inside(end)


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """(start, piece) of k + 1 pieces that make up the item, their lengths one apart at most."""
    limits = [i * len(item) // (k + 1) for i in range(k + 2)]
    return [(s, item[s:e]) for s, e in zip(limits, limits[1:], strict=False)]


class Pattern:
    """Myers' automaton of an item; Python's integers hold a column of any height."""

    def __init__(self, item: str, k: int, whole: bool = False) -> None:
        self.size, self.k, self.whole = len(item), k, whole  # whole: matches at borders of words only
        self.equal: dict[str, int] = {}
        for i, c in enumerate(item):
            self.equal[c] = self.equal.get(c, 0) | 1 << i

    def best(self, text: str) -> tuple[int, int] | None:
        """(distance, end) of the closest occurrence in a text, the first of equally close ones; None beyond k edits."""
        full, top = (1 << self.size) - 1, 1 << (self.size - 1)
        plus, minus, score, found = full, 0, self.size, None
        for end, c in enumerate(text, 1):
            eq = self.equal.get(c, 0)
            vertical = eq | minus
            horizontal = (((eq & plus) + plus) ^ plus) | eq
            up, down = minus | (full & ~(horizontal | plus)), plus & horizontal
            if up & top:
                score += 1
            elif down & top:
                score -= 1
            up, down = (up << 1) & full, (down << 1) & full
            plus, minus = down | (full & ~(vertical | up)), up & vertical
            if score <= self.k and (found is None or score < found[0]):
                found = (score, end)
        return found


def distances(patterns: list[Pattern], windows: list[str]) -> list[tuple[int, int] | None]:
    """``Pattern.best`` of each pattern in its window, all at once: a column is a row of 64-bit words for each pattern."""
    if not patterns:
        return []
    words = max(-(-p.size // 64) for p in patterns)
    n, kinds = len(patterns), list({id(p): p for p in patterns}.values())
    alphabet = np.array(sorted({ord(c) for p in kinds for c in p.equal}), np.uint32)
    equal = np.zeros((len(kinds), len(alphabet) + 1, words), np.uint64)  # the last row is of characters that no pattern has
    for k, p in enumerate(kinds):
        for c, bits in p.equal.items():
            equal[k, np.searchsorted(alphabet, ord(c))] = np.frombuffer(bits.to_bytes(8 * words, "little"), "<u8")
    number = {id(p): k for k, p in enumerate(kinds)}
    which = np.array([number[id(p)] for p in patterns])
    lengths = np.array([len(w) for w in windows])
    code = np.full((n, lengths.max(initial=0)), len(alphabet))
    for i, w in enumerate(windows):
        points = np.frombuffer(w.encode("utf-32-le", "surrogatepass"), "<u4")
        at = np.minimum(np.searchsorted(alphabet, points), len(alphabet) - 1)
        code[i, : len(points)] = np.where(alphabet[at] == points, at, len(alphabet))
    size, budget = np.array([p.size for p in patterns]), np.array([p.k for p in patterns])
    top, bit, every = (size - 1) // 64, ((size - 1) % 64).astype(np.uint64), np.arange(n)
    one, last = np.uint64(1), np.uint64(63)
    plus, minus = np.full((n, words), ~np.uint64(0)), np.zeros((n, words), np.uint64)
    score, best, end = size.copy(), budget + 1, np.zeros(n, np.int64)
    for t in range(code.shape[1]):
        eq = equal[which, code[:, t]]
        added, total, carry = eq & plus, np.empty_like(plus), np.zeros(n, np.uint64)
        for w in range(words):
            part = added[:, w] + plus[:, w]
            total[:, w] = part + carry
            carry = ((part < added[:, w]) | (total[:, w] < part)).astype(np.uint64)
        vertical, horizontal = eq | minus, (total ^ plus) | eq
        up, down = minus | ~(horizontal | plus), plus & horizontal
        score = score + ((up[every, top] >> bit) & one).astype(np.int64) - ((down[every, top] >> bit) & one).astype(np.int64)
        for column in (up, down):
            over = column[:, :-1] >> last
            column <<= one
            column[:, 1:] |= over
        plus, minus = down | ~(vertical | up), up & vertical
        better = (score < best) & (t < lengths)
        best[better], end[better] = score[better], t + 1
    return [(int(b), int(e)) if b <= k else None for b, e, k in zip(best, end, budget, strict=True)]


class Matcher:
    """The pieces of a block of items. ``together``: how many places are verified at once."""

    def __init__(self, items: list[tuple[object, str]], config: Config, together: int = 512) -> None:
        import ahocorasick

        self.patterns: list[tuple[object, str, Pattern]] = []
        self.together = together
        where: dict[str, list[tuple[int, int]]] = {}
        for key, text in items:
            item = normalised(text)
            short = len(item) < config.min_chars
            if short and is_one_word(item):
                continue
            pattern = Pattern(item, 0 if short else int(config.error_rate * len(item)), short)
            for start, piece in pieces(item, pattern.k):
                where.setdefault(piece, []).append((len(self.patterns), start))
            self.patterns.append((key, item, pattern))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[object, int, int]]:
        """(item, distance, end in the normalised text) of each item that a text holds."""
        return self.search([normalised(text)])[0]

    def search(self, texts: list[str]) -> list[list[tuple[object, int, int]]]:
        """``matches`` of each of many normalised texts."""
        best: list[dict[int, tuple[int, int]]] = [{} for _ in texts]
        waiting: list[tuple[int, int, int]] = []  # (text, pattern, first place of the window)

        def verify() -> None:
            waiting.sort(key=lambda e: self.patterns[e[1]][2].size)
            for i in range(0, len(waiting), self.together):
                part = [e for e in waiting[i : i + self.together] if best[e[0]].get(e[1], (1,))[0]]
                chosen = [self.patterns[which][2] for _, which, _ in part]
                found = distances(chosen, [texts[t][first : first + p.size + 2 * p.k] for (t, _, first), p in zip(part, chosen, strict=True)])
                for (t, which, first), hit in zip(part, found, strict=True):
                    if hit:
                        best[t][which] = min(best[t].get(which, (hit[0], first + hit[1])), (hit[0], first + hit[1]))
            waiting.clear()

        for t, text in enumerate(texts if self.patterns else ()):
            tried: set[tuple[int, int]] = set()
            for end, (size, places) in self.automaton.iter(text):
                for which, start in places:
                    origin = end + 1 - size - start  # where the item would begin without an edit before the piece
                    if (which, origin) in tried or best[t].get(which, (1,))[0] == 0:
                        continue
                    tried.add((which, origin))
                    _, item, pattern = self.patterns[which]
                    if origin >= 0 and text.startswith(item, origin):
                        if not pattern.whole or at_borders(text, origin, origin + pattern.size):
                            best[t][which] = (0, origin + pattern.size)
                    elif pattern.k:
                        waiting.append((t, which, max(0, origin - pattern.k)))
            if len(waiting) >= 16 * self.together:
                verify()
        verify()
        return [[(self.patterns[which][0], *found) for which, found in its.items()] for its in best]


def item_passes(items: DataFrame, config: Config, item_id: str, text: str) -> Iterator[list[list[tuple[object, str]]]]:
    """Items in blocks of about ``block_chars`` characters, the blocks of about ``pass_chars`` together; equal items share their search."""
    usable = items.where(F.col(text).isNotNull()).select(F.col(item_id).alias("key"), F.col(text).cast("string").alias("text"))
    total = usable.agg(F.sum(F.length("text"))).first()[0] or 0
    passes = max(1, -(-total // config.pass_chars))
    for i in range(passes):
        part = usable if passes == 1 else usable.where(F.pmod(F.xxhash64("text", F.col("key").cast("string")), F.lit(passes)) == i)
        blocks, room = [[]], config.block_chars
        for key, value in sorted(((r["key"], r["text"]) for r in part.toLocalIterator()), key=lambda e: (len(e[1]), repr(e))):
            if blocks[-1] and room < len(value):
                blocks.append([])
                room = config.block_chars
            blocks[-1].append((key, value))
            room -= len(value)
        yield blocks


def _search(sent, config: Config) -> Callable[[pa.Array], list[list[tuple[object, int, int]]]]:
    """A function from texts to what each of them holds of the blocks that were sent."""
    matcher = lru_cache(maxsize=config.held)(lambda k: Matcher(sent.value[k], config))

    def run(values: pa.Array) -> list[list[tuple[object, int, int]]]:
        texts = [normalised(v) if v else "" for v in (x.as_py() for x in values)]
        found: list[list[tuple[object, int, int]]] = [[] for _ in texts]
        for k in range(len(sent.value)):
            for its, more in zip(found, matcher(k).search(texts), strict=True):
                its += more
        return found

    return run


def _slices(batches: Iterator[pa.RecordBatch], column: int | str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of batches whose texts have about ``most`` bytes, a row at least."""
    for batch in batches:
        upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + most, "right")))
            yield batch.slice(first, last - first)
            first = last


def find_leaks(docs: DataFrame, items: DataFrame, config: Config = Config(), doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, distance, end_char): each item that each document holds within its error budget."""
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    made = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("item_id", items.schema[item_id].dataType), T.StructField("distance", T.IntegerType()), T.StructField("end_char", T.IntegerType())])
    arrow = to_arrow_schema(made)
    found = None
    for blocks in item_passes(items, config, item_id, item_text):
        sent = docs.sparkSession.sparkContext.broadcast(blocks)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            search = _search(sent, config)
            for batch in _slices(batches, 1):
                rows = [(i, *match) for i, its in enumerate(search(batch.column(1))) for match in its]
                at, keys, distance, ends = zip(*rows, strict=True) if rows else ([],) * 4
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *[pa.array(c, f.type) for c, f in zip((keys, distance, ends), list(arrow)[1:], strict=True)]], names=arrow.names)

        part = texts.mapInArrow(run, made)
        found = part if found is None else found.unionByName(part)
    return found


def keep(docs: DataFrame, items: DataFrame, config: Config = Config(), text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no item, with their columns; a filter within the one pass over the texts."""
    result = docs
    for blocks in item_passes(items, config, item_id, item_text):
        sent = docs.sparkSession.sparkContext.broadcast(blocks)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            search = _search(sent, config)
            for batch in _slices(batches, text):
                yield batch.filter(pa.array([not its for its in search(batch.column(text))], pa.bool_()))

        result = result.mapInArrow(run, docs.schema)
    return result
