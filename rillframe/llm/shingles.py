"""Hashes of words and word shingles for whole batches of texts at a time, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

_WORD = np.uint64(0x9E3779B97F4A7C15)
SIZE = 5


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit changes about half of the output bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """A random value for each byte, and which bytes are white space (20 and 09 to 0D)."""
    values = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    space = np.zeros(256, bool)
    space[[0x20, *range(0x09, 0x0E)]] = True
    return values, space


_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64
_powers: dict[str, np.ndarray] = {}


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 20)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of lower-cased texts, in order, and how many words each text has."""
    joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    values, space = _tables()
    gap = space[joined]
    edges = np.flatnonzero(np.diff(np.concatenate([[True], gap]).view(np.int8)))  # word starts and ends, in turn
    starts, ends = edges[0::2], edges[1::2]
    up, down = _powers_to(len(joined) + 1)
    sums = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum(values[joined] * up[: len(joined)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _WORD)
    limits = np.cumsum([len(t) + 1 for t in texts])
    per_text = np.diff(np.searchsorted(starts, limits), prepend=0)
    return hashes, per_text


def shingle_sets(texts: list[bytes], block: int = 1 << 20) -> Iterator[np.ndarray]:
    """For each lower-cased text the sorted distinct 64-bit hashes of its five-word shingles.

    A text of one to four words gives one hash, of the whole sequence; one without words gives none.
    """
    for first, last in _blocks([len(t) + 1 for t in texts], block):
        hashes, counts = word_hashes(texts[first:last])
        windows = np.zeros(0, np.uint64)
        if len(hashes) >= SIZE:
            n = len(hashes) - SIZE + 1
            windows = hashes[:n].copy()
            for k in range(1, SIZE):
                windows = windows * np.uint64(0xD6E8FEB86659FD93) + hashes[k : k + n]
            windows = mix(windows)
        start = 0
        for count in counts.tolist():
            if count >= SIZE:
                yield np.unique(windows[start : start + count - SIZE + 1])
            elif count:
                h = np.uint64(count)
                with np.errstate(over="ignore"):
                    for w in hashes[start : start + count]:
                        h = h * np.uint64(0xA0761D6478BD642F) + w
                yield mix(np.array([h]))
            else:
                yield np.zeros(0, np.uint64)
            start += count


def _blocks(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    first, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield first, i
            first, total = i, 0
        total += n
    if first < len(sizes):
        yield first, len(sizes)


def prepared(text: str | None) -> bytes:
    """UTF-8 with A-Z lower-cased."""
    return (text or "").encode("utf-8", "replace").lower()
