"""Shuffling into shards by a permutation of the global row numbers that can be computed both ways.

Rows are numbered from 0 in an order of their own contents, so the numbers depend neither on files nor on
partitions. A Feistel network permutes the numbers 0 to n - 1: a number is a pair (left, right) of a grid of
a times b cells, the smallest near-square one with n cells or more, and each round adds a keyed hash of one half to
the other, modulo its side. A result outside 0 to n - 1 goes through the network again (cycle walking) until it is
inside; fewer than a cells are outside, so hardly any does. The place p of a row gives shard p mod shards and slot p
div shards: counts differ by one at most, slots have no gaps, and any (shard, slot) leads back to its row
number without a table, by the rounds backwards.

Null texts have no bytes, so size 1 and checksum 0. Equal rows are rows of their own, next to each other in number, and
which of them gets which place doesn't show. An empty table gives an empty result. Null keys come first.
Only keys, sizes and checksums are shuffled, not texts, unless a text is asked to be carried along.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, small_batches
from .ranks import ranked

SHARDS, SEED, ROUNDS = 16, 20240607, 6
#: Odd multipliers below 2^31, so that a product of two halves fits 64 bits, and the halves' bits.
FACTORS, BITS = (739_982_445, 695_872_825, 1_103_515_245), (1 << 31) - 1


@dataclass(frozen=True)
class Permutation:
    """Of 0 to n - 1, by the seed."""

    n: int
    seed: int = SEED
    rounds: int = ROUNDS

    def __post_init__(self):
        if not 0 <= self.n < 1 << 61:
            raise ValueError("the halves of a row number must fit 31 bits")

    @property
    def sides(self) -> tuple[int, int]:
        a = isqrt(max(self.n - 1, 0)) + 1
        return a, max(1, -(-self.n // a))

    def key(self, i: int) -> int:
        """Of a round."""
        return (self.seed * FACTORS[2] + (i + 1) * FACTORS[0]) & BITS

    def _hash(self, half: np.ndarray, i: int) -> np.ndarray:
        h = (half + self.key(i)) & BITS
        for factor in FACTORS[:2]:
            h = ((h ^ (h >> 15)) * factor) & BITS
        return h ^ (h >> 13)

    def _once(self, x: np.ndarray) -> np.ndarray:
        a, b = self.sides
        left, right = x // b, x % b
        for i in range(0, self.rounds, 2):
            left = (left + self._hash(right, i)) % a
            right = (right + self._hash(left, i + 1)) % b
        return left * b + right

    def _back(self, x: np.ndarray) -> np.ndarray:
        a, b = self.sides
        left, right = x // b, x % b
        for i in reversed(range(0, self.rounds, 2)):
            right = (right - self._hash(left, i + 1)) % b
            left = (left - self._hash(right, i)) % a
        return left * b + right

    def _walk(self, x: np.ndarray, step: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        out = step(np.asarray(x, dtype=np.int64))
        while len(outside := np.flatnonzero(out >= self.n)):
            out[outside] = step(out[outside])
        return out

    def place(self, row: np.ndarray) -> np.ndarray:
        return self._walk(row, self._once)

    def row(self, place: np.ndarray) -> np.ndarray:
        """The row number that has a place."""
        return self._walk(place, self._back)


def row_at(shard: int, slot: int, n: int, shards: int = SHARDS, seed: int = SEED) -> int:
    """The number of the row in a slot of a shard: what a reader that restarts in the middle asks for."""
    place = slot * shards + shard
    if not (0 <= shard < shards and 0 <= place < n):
        raise IndexError(f"shard {shard} has no slot {slot}")
    return int(Permutation(n, seed).row(np.array([place]))[0])


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, size (UTF-8 bytes of the text plus 1), text_crc32: what rows are numbered by."""
    shown = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(F.col(f"`{key}`").alias("key"), (F.octet_length(shown) + 1).cast("long").alias("size"), F.crc32(shown).alias("text_crc32"))


def into_shards(rows: DataFrame, order: list[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """rows with row_number, shard and slot, in place of columns of these names. Rows that are equal in all of order must be alike in what matters."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    small_batches(rows.sparkSession)
    rows = rows.drop("row_number", "shard", "slot")
    tie = free_name(rows, "_tie")
    numbered, n = ranked(rows.withColumn(tie, F.monotonically_increasing_id()), [F.col(f"`{c}`") for c in order], tie, "row_number")
    permutation = Permutation(n, seed)

    @F.pandas_udf("long")
    def place(row: pd.Series) -> pd.Series:
        return pd.Series(permutation.place(row.to_numpy()))

    out = numbered.withColumn("_place", place("row_number"))
    return out.withColumn("shard", (F.col("_place") % shards).cast("int")).withColumn("slot", F.floor(F.col("_place") / shards).cast("long")).drop("_place")


def write_shards(rows: DataFrame, order: list[str], path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Writes rows (all columns, texts too) as one folder a shard, each row with its slot. A shard's slots are cut into ranges, one file each, so that a shard isn't one task's work; the files of a shard, by name, are in the order of slots."""
    files = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    into_shards(rows, order, shards, seed).drop("row_number").repartitionByRange(files, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
