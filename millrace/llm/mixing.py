"""Mixing sources to target weights by the cube method.

A source of target T and size S takes each of its documents T/S times: the whole part for certain, the
rest by balanced sampling. Inclusion probabilities start at that fraction and move along vectors that keep
both the expected documents and the expected words of the sample, until one of three active documents is
in or out; then the next takes its place. Documents are dealt to blocks of a bounded size by a hash; in a
block those of like sizes (by powers of two) decide among themselves and leave at most two undecided, and the
undecided meet in ever fewer blocks of their source. The last dozen of a source is landed by trying every
choice and taking the one whose words come nearest to the balance.

Null texts and texts without words have size 0 and are taken 0 words. Null sources are one source, the last.
All randomness is a hash of the key, the size and, among rows that agree in source, key and size, of a number that each
gets from their count, so reruns agree; repeated rows are drawn each by itself and spread over blocks.
An empty table gives an empty result.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, small_batches, unit_hash, written

WEIGHTS = (5.0, 2.0, 1.0)
#: Documents in a block of the flight, about, and the most that are landed together.
BLOCK, LANDING = 4096, 14
#: Documents that a block may leave undecided, about: two of each size class.
LEFT = 64
#: Sources at most: their totals come to the driver, a row each.
MAX_SOURCES = 100_000


def targets(sizes: dict[str | None, int], weights: tuple[float, ...] = WEIGHTS, limit: float = 3.0) -> dict[str | None, float]:
    """Words for each source: shares of all words by weight, at most limit times the source's own; the excess is shared anew among the others."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out: dict[str | None, float] = {}
    left, rest = names, float(sum(sizes.values()))
    while left:
        whole = sum(weight[s] for s in left)
        share = {s: rest * weight[s] / whole for s in left}
        over = [s for s in left if share[s] > limit * sizes[s]]
        if not over:
            return out | share
        for s in over:
            out[s] = limit * sizes[s]
            rest -= out[s]
        left = [s for s in left if s not in out]
    return out


def flight(p: np.ndarray, size: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Moves p until at most two of its values lie between 0 and 1, keeping sum(p) and sum(p * size)."""
    p = p.astype(float).copy()
    order = iter(np.flatnonzero((p > 1e-9) & (p < 1 - 1e-9)).tolist())
    active: list[int] = []
    while True:
        active += itertools.islice(order, 3 - len(active))
        if len(active) < 3:
            return p
        i, j, k = active
        a, b, c = size[i], size[j], size[k]
        u = np.array([b - c, c - a, a - b], dtype=float)  # across (1, 1, 1) and the sizes
        if not u.any():
            u = np.array([1.0, -1.0, 0.0])  # equal sizes: any exchange keeps the balance
        x = p[active]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(u > 0, (1 - x) / u, np.where(u < 0, -x / u, np.inf)).min()
            down = np.where(u > 0, x / u, np.where(u < 0, (x - 1) / u, np.inf)).min()
        x = x + up * u if draw[i] * (up + down) < down else x - down * u
        draw[j], draw[k] = (draw[j] + draw[i]) % 1, (draw[k] + draw[j]) % 1  # a fresh number for who stays
        x[x < 1e-9], x[x > 1 - 1e-9] = 0.0, 1.0
        p[active] = x
        active = [m for m in active if 0 < p[m] < 1]


def landing(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """0 or 1 for each of a few: the choice whose words come nearest to the expected, then the one nearest in number."""
    choices = (np.arange(1 << len(p))[:, None] >> np.arange(len(p))) & 1
    words, number = np.abs(choices @ size - p @ size), np.abs(choices.sum(axis=1) - p.sum())
    return choices[np.lexsort((number, np.round(words, 6)))[0]].astype(float)


def _fly(last: bool):
    def fly(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["draw", "key", "size", "nth"], kind="stable").reset_index(drop=True)
        size, p, draw = (part[c].to_numpy(dtype=float).copy() for c in ("size", "p", "draw"))
        # documents of like sizes decide among themselves: one far longer than the others would hardly move
        kind = np.floor(np.log2(np.maximum(size, 1)))
        for k in np.unique(kind):
            own = np.flatnonzero(kind == k)
            p[own] = flight(p[own], size[own], draw[own].copy())
        if last:
            left = np.flatnonzero((p > 0) & (p < 1))
            left = left[np.argsort(size[left], kind="stable")]
            if len(small := left[: max(0, len(left) - LANDING + 2)]) > 2:
                p[small] = flight(p[small], size[small], draw[small].copy())
            left = np.flatnonzero((p > 0) & (p < 1))
            if len(left):
                p[left] = landing(p[left], size[left])
        return part.assign(p=p)

    return fly


def sizes_of(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.withColumn("size", F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(rf"[^{SPACE}]+")).cast("long"))


def numbered(rows: DataFrame) -> DataFrame:
    """source, key, size, nth (from 0 among rows that agree in these) for each of rows, which are counted first: many equal rows are one count, dealt to tasks by BLOCK and numbered there."""
    counts = written(rows.groupBy("source", "key", "size").agg(F.count("*").alias("n")), "sizes")  # the texts are read once
    few = counts.where(F.col("n") <= BLOCK).withColumn("first", F.lit(0).cast("long"))
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(BLOCK).cast("long")))
    many = counts.where(F.col("n") > BLOCK).withColumn("first", parts).repartition("first", "key")
    every = F.explode(F.sequence("first", F.least(F.col("first") + BLOCK, F.col("n")) - 1))
    return few.unionByName(many).select("source", "key", "size", every.alias("nth"))


def dealt(rows: DataFrame, seed: int) -> DataFrame:
    """rows with block, of as many as blocks says."""
    return rows.withColumn("block", F.pmod(F.xxhash64("key", "size", "nth", F.lit(seed)), F.col("blocks")))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, limit: float = 3.0, text: str = "text", source: str = "source", key: str = "doc_id") -> DataFrame:
    """key, size, source_size, target, copies, taken: a row for each of docs."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = numbered(sizes_of(docs.select(F.col(key).alias("key"), F.col(source).alias("source"), F.col(text).alias("_text")), "_text"))
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    found = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    goal = targets({r["source"]: r["size"] for r in found}, weights, limit)
    plan = [(r["source"], r["size"], goal[r["source"]], goal[r["source"]] / r["size"] if r["size"] else 0.0, -(-r["n"] // BLOCK)) for r in found]
    plan = spark.createDataFrame(plan, "source string, source_size long, target double, rate double, blocks long")
    rows = rows.join(F.broadcast(plan), rows["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    whole = F.floor(F.col("rate") + 1e-9)
    rows = rows.withColumn("whole", whole.cast("int")).withColumn("p", F.greatest(F.lit(0.0), F.col("rate") - F.col("whole")))
    rows = rows.withColumn("p", F.when(F.col("size") == 0, 0.0).otherwise(F.when(F.col("p") < 1e-9, 0.0).otherwise(F.col("p"))))
    unit = f"row long, key {dict(rows.dtypes)['key']}, source string, size long, nth long, p double, draw double, blocks long, block long"
    draw = unit_hash(F.col("key"), F.col("size"), F.col("nth"), F.lit(9))
    open_ = dealt(rows.where("p > 0").select("row", "key", "source", "size", "nth", "p", draw.alias("draw"), "blocks"), 90)
    decided, most = [], max((r["blocks"] for r in plan.collect()), default=0)
    while most > 0:
        out = open_.groupBy("source", "block").applyInPandas(_fly(most == 1), unit)
        out = written(out, f"flight{most}")
        decided.append(out.where((F.col("p") == 0) | (F.col("p") == 1)).select("row", (F.col("p") == 1).cast("int").alias("drawn")))
        if most == 1:
            break
        meet = max(2, BLOCK // LEFT)
        fewer = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("blocks") / meet))
        open_ = dealt(out.where((F.col("p") > 0) & (F.col("p") < 1)).withColumn("blocks", fewer.cast("long")), 91)
        most = -(-most // meet)
    drawn = decided[0] if decided else rows.limit(0).select("row", F.lit(0).alias("drawn"))
    for more in decided[1:]:
        drawn = drawn.unionByName(more)
    rows = rows.join(drawn, "row", "left")
    copies = (F.col("whole") + F.coalesce("drawn", F.lit(0))).cast("int")
    return rows.select(F.col("key").alias(key), "size", "source_size", "target", F.least(copies, F.lit(int(limit))).alias("copies")).withColumn("taken", F.col("copies") * F.col("size"))
