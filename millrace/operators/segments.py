"""Scans in feed order that cut large feeds, so that no feed is one task's work.

Where a feed has more than SEGMENT rows, all rows are dealt to ranges of (feed, ordinal). A range is scanned by itself
and leaves a summary of a few values for each feed in it; summaries of one feed combine from left to right as the rows
themselves would, by a window over summaries. Only where each row needs an answer are the carries joined back: a range
has at most one feed that goes on from the range before, so there are fewer carries than ranges and they are broadcast.
Where no feed is that large a feed is one range, and rows are shuffled once, by feed.

Null feeds are one feed, null ordinals come first, rows that tie on ordinal are in any order; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import materialised

#: Rows of a range, about.
SEGMENT = 1_000_000


def cut(rows: DataFrame, feed: list[str], ordinal: str) -> tuple[DataFrame, bool]:
    """rows with _segment, and whether any feed was cut. Ranges are written, as where they begin is found by a sample."""
    counts = rows.groupBy(*feed).agg(F.count("*").alias("n"))
    total, largest = counts.agg(F.sum("n"), F.max("n")).first()
    if (largest or 0) <= SEGMENT:
        return rows.withColumn("_segment", F.lit(0)), False
    ranges = rows.repartitionByRange(-(-total // SEGMENT), *map(F.col, feed), F.col(ordinal))
    return materialised(ranges.withColumn("_segment", F.spark_partition_id()), "segments"), True


def _windows(feed: list[str], ordinal: str):
    """In a range by ordinal; over a feed's summaries, and over those before."""
    over = Window.partitionBy(*feed).orderBy("_segment")
    return Window.partitionBy(*feed, "_segment").orderBy(ordinal), over, over.rowsBetween(Window.unboundedPreceding, -1)


def falls(rows: DataFrame, value: str, ordinal: str, feed: list[str]) -> DataFrame:
    """By feed that has values: n, and how many are smaller than the one before. Null values are passed over; feeds are measured with them, so that no value is computed for that."""
    pieces, _ = cut(rows.select(*feed, ordinal, value), feed, ordinal)
    pieces = pieces.where(F.col(value).isNotNull())
    inside, over, _ = _windows(feed, ordinal)
    pieces = pieces.withColumn("_i", F.row_number().over(inside)).withColumn("_p", F.lag(value).over(inside))
    parts = pieces.groupBy(*feed, "_segment").agg(
        F.count("*").alias("_n"), F.count_if(F.col(value) < F.col("_p")).alias("_falls"), F.min_by(value, "_i").alias("_first"), F.max_by(value, "_i").alias("_last")
    )
    between = F.coalesce((F.col("_first") < F.lag("_last").over(over)).cast("long"), F.lit(0))
    return parts.withColumn("_falls", F.col("_falls") + between).groupBy(*feed).agg(F.sum("_n").alias("n"), F.sum("_falls").alias("falls"))


def first_run(rows: DataFrame, holds: str, ordinal: str, feed: list[str], k: int) -> DataFrame:
    """By feed that has any: at, the ordinal of the first row that ends k rows in a row for which holds (boolean, null doesn't hold).

    A range's summary is its rows, the last that doesn't hold, its own first run, and the ordinals of the fewer than k rows that begin it."""
    pieces, _ = cut(rows.select(*feed, ordinal, F.coalesce(holds, F.lit(False)).alias("_holds")), feed, ordinal)
    inside, _, before = _windows(feed, ordinal)
    pieces = pieces.withColumn("_i", F.row_number().over(inside))
    broke = F.max(F.when(~F.col("_holds"), F.col("_i"))).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    pieces = pieces.withColumn("_run", F.col("_i") - F.coalesce(broke, F.lit(0)))
    leads = (F.col("_run") == F.col("_i")) & (F.col("_i") < k)
    parts = pieces.groupBy(*feed, "_segment").agg(
        F.count("*").alias("_n"),
        F.max(F.when(~F.col("_holds"), F.col("_i"))).alias("_broke"),
        F.min_by(ordinal, F.when(F.col("_run") == k, F.col("_i"))).alias("_own"),
        F.array_sort(F.collect_list(F.when(leads, F.struct("_i", F.col(ordinal).alias("at"))))).alias("_lead"),
    )
    parts = parts.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    carried = F.col("_offset") - F.coalesce(F.max(F.col("_offset") + F.col("_broke")).over(before), F.lit(0))
    parts = parts.withColumn("_carried", carried.cast("int"))
    joint = F.when(F.col("_carried").between(1, k - 1), F.get("_lead", F.lit(k - 1) - F.col("_carried"))["at"])
    return parts.select(*feed, F.coalesce(joint, F.col("_own")).alias("at"), "_segment").where("at is not null").groupBy(*feed).agg(F.min_by("at", "_segment").alias("at"))


def since_growth(rows: DataFrame, size: str, ordinal: str, feed: list[str], name: str) -> DataFrame:
    """rows with how many have passed since size last grew (a size that can't be compared counts as growth), as a long."""
    pieces, was_cut = cut(rows, feed, ordinal)
    inside, over, before = _windows(feed, ordinal)
    pieces = pieces.withColumn("_i", F.row_number().over(inside)).withColumn("_up", F.coalesce(F.col(size) > F.lag(size).over(inside), F.lit(True)))
    grew = F.when((F.col("_i") > 1) & F.col("_up"), F.col("_i"))
    here = F.max(grew).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    if not was_cut:
        return pieces.withColumn(name, (F.col("_i") - F.coalesce(here, F.lit(1))).cast("long")).drop("_i", "_up", "_segment")
    parts = pieces.groupBy(*feed, "_segment").agg(
        F.count("*").alias("_n"), F.max(grew).alias("_grew"), F.min_by(size, "_i").alias("_first"), F.max_by(size, "_i").alias("_last"))
    parts = parts.withColumns({"_offset": F.coalesce(F.sum("_n").over(before), F.lit(0)), "_begins": F.coalesce(F.col("_first") > F.lag("_last").over(over), F.lit(True)), "_place": F.row_number().over(over)})
    grown = F.col("_offset") + F.coalesce("_grew", F.when(F.col("_begins"), 1))
    parts = parts.withColumn("_carried", F.col("_offset") - F.max(grown).over(before)).where("_place > 1")
    carries = parts.select(F.struct(*feed).alias("_feed"), F.col("_segment").alias("_of"), "_begins", "_carried")
    pieces = pieces.withColumn("_here", here)
    on = (pieces["_segment"] == carries["_of"]) & F.struct(*(pieces[f] for f in feed)).eqNullSafe(carries["_feed"])
    told = pieces.join(F.broadcast(carries), on, "left")
    at = F.coalesce(F.col("_here"), F.when(F.coalesce("_begins", F.lit(True)), 1))
    stuck = F.coalesce(F.col("_i") - at, F.col("_carried") + F.col("_i"))
    return told.withColumn(name, stuck.cast("long")).select(*rows.columns, name)
