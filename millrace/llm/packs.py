"""The corpus packed once into a bucketed table, for operators that read all texts several times.

A part is a run of rows of one input partition, of a bounded number of bytes; all of a part lies in one
bucket, so small answers (a row for each part and shard) join it without shuffling the texts again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Bytes of text in a row, and in a part.
PACK, PART = 1 << 20, 32 << 20


def pack(keys: list[int], texts: list[bytes]) -> bytes:
    head = np.array([len(keys), *keys, *map(len, texts)], dtype=np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(texts))


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, sizes, bytes."""
    raw = zstandard.ZstdDecompressor().decompress(packed)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, 1 + 2 * n)
    return head[1 : n + 1], head[n + 1 :], np.frombuffer(raw, np.uint8, offset=8 * (1 + 2 * n))


def compress(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(x).tobytes())


def expand(x: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), dtype=dtype)


def six(h: np.ndarray) -> bytes:
    """48-bit numbers in six bytes each."""
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def from_six(x: bytes) -> np.ndarray:
    out = np.zeros((len(x) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(x, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def by_shard(h: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places of h by shard, in the order of h."""
    shard = (h % np.uint64(shards)).astype(np.uint16 if shards <= 1 << 16 else np.int64)  # short numbers are sorted by radix
    order = np.argsort(shard, kind="stable")
    cut = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in range(shards):
        if cut[s + 1] > cut[s]:
            yield s, order[cut[s] : cut[s + 1]]


@contextmanager
def packed(rows: DataFrame, more: Callable[[list[int], list[bytes]], bytes] | None = None):
    """rows (key long, text binary, neither null) as a table (part, seq, size, pack, more) and its number of buckets; more is what the function says of a pack. The table goes when the context ends, so results must be written by then."""
    spark = rows.sparkSession

    def packs(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, at, seq, keys, texts, size, whole = TaskContext.get().partitionId() << 16, 0, 0, [], [], 0, 0

        def row() -> pd.DataFrame:
            return pd.DataFrame({"part": [first + at], "seq": [seq], "size": [size], "pack": [pack(keys, texts)], "more": [more(keys, texts) if more else b""]})

        for part in parts:
            for k, t in zip(part["key"], part["text"], strict=True):
                keys.append(k)
                texts.append(bytes(t))
                size += len(t)
                if size >= PACK:
                    yield row()
                    whole += size
                    seq, keys, texts, size = seq + 1, [], [], 0
                    if whole >= PART:
                        at, whole = at + 1, 0
        if keys:
            yield row()

    table = rows.mapInPandas(packs, "part long, seq int, size long, pack binary, more binary")
    buckets = min(100_000, int(spark.conf.get("spark.sql.shuffle.partitions")))  # that many is the limit of a bucketed table
    name = f"millrace_packs_{uuid.uuid4().hex}"
    table.write.format("parquet").option("compression", "uncompressed").bucketBy(buckets, "part").saveAsTable(name)
    try:
        yield spark.table(name), buckets
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
