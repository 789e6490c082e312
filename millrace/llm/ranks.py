"""Global places of rows in an order, without a window over all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, written


def ranked(rows: DataFrame, order: list[Column], tie: str, rank: str = "rank") -> tuple[DataFrame, int]:
    """rows without tie but with rank (long, from 0, in the order given, nulls first), and how many rows there are.

    Rows are dealt by ranges of order and tie, sorted within, numbered, and written; a prefix sum of the
    partitions' counts (a row each on the driver) makes the numbers global. tie is a column of different numbers
    that the scan gave (monotonically_increasing_id): it cuts runs of rows that are equal in all of order, which
    would else lie in one partition however many they are. Rows that order doesn't tell apart have their ranks
    in any order, so order by all columns that matter. The written table is read by what is returned."""
    part, place = free_name(rows, "_part"), free_name(rows, "_place")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *order, F.col(tie)).sortWithinPartitions(*order, F.col(tie)).drop(tie)
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    stored = written(dealt.withColumns({part: F.spark_partition_id(), place: inside}), "ranked")
    before, n = [], 0
    for at, count in sorted((r[0], r[1]) for r in stored.groupBy(part).count().collect()):
        before.append((at, n))
        n += count
    offsets = rows.sparkSession.createDataFrame(before, f"{part} int, _before long")
    out = stored.join(F.broadcast(offsets), part).withColumn(rank, F.col("_before") + F.col(place))
    return out.select(*(c for c in rows.columns if c != tie), rank), n
