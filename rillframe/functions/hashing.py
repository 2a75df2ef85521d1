"""Keyed hashes and the split of episodes that follows from them."""

from __future__ import annotations

import struct
from hashlib import blake2b

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SPLITS = ("train", "val", "test")


def stable_hash(number: int, seed: int = 0, bits: int = 64) -> int:
    """BLAKE2b over a whole number's decimal digits, keyed by the low 8 bytes of the seed: the same in every process."""
    size, rest = divmod(bits, 8)
    if rest or size not in range(1, blake2b.MAX_DIGEST_SIZE + 1):
        raise ValueError(f"no digest of {bits} bits")
    keyed = blake2b(b"%d" % number, digest_size=size, key=struct.pack("<Q", seed % 2**64))
    return int(keyed.hexdigest(), 16)


def unit_interval(value: int, bits: int = 64) -> float:
    """A hash's place in [0, 1]."""
    return value / (2**bits - 1)


def check_fractions(train: float, val: float, test: float) -> None:
    if abs(train + val + test - 1) > 1e-9:
        raise ValueError("train, val and test must sum to 1")


def unit_hash(seed: int = 42):
    """A vectorized function from ids to [0, 1]; meant for distinct ids."""

    @F.pandas_udf("double")
    def run(ids: pd.Series) -> pd.Series:
        return ids.map(lambda i: None if pd.isna(i) else unit_interval(stable_hash(int(i), seed)))

    return run


def split_of(unit: Column, train: float = 0.8, val: float = 0.1, test: float = 0.1) -> Column:
    check_fractions(train, val, test)
    return F.when(unit.isNull(), None).when(unit < train, "train").when(unit < train + val, "val").otherwise("test")


def sha_unit(text: Column) -> Column:
    """A native unit hash: the first 52 bits of the text's SHA-256, as a share."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("double") / float(2**52)
