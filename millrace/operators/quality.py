"""Batch reports and gates: counts, lengths and times only, never texts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.ages import age_seconds, age_unit
from ..functions.textops import CLAMP, NEAR
from ..sources.shared import materialised
from . import segments
from .dedup import first_with

#: Different values that meet in a task, about.
PIECE = 1_000_000
#: A batch smaller than this isn't judged on shares.
ENOUGH = 20


def order_statistic(rows: DataFrame, value: Column, bucket: Column, rank: Column, name: str) -> DataFrame:
    """One row: the value at a rank (from 0, an expression of n, the number of non-null values) in sorted order. Buckets must sort as their values do; only counts of buckets, then of one bucket's values, meet in one task."""
    values = rows.select(value.alias("v"), bucket.alias("b")).where("v is not null")
    counts = values.groupBy("b", "v").agg(F.count("*").alias("c"))
    of_bucket = counts.groupBy("b").agg(F.sum("c").alias("c"))
    n = F.sum("c").over(Window.partitionBy())
    before = F.coalesce(F.sum("c").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = of_bucket.select("b", "c", n.alias("n"), before.alias("before")).withColumn("rank", rank)
    place = place.where("rank >= before AND rank < before + c").select(F.col("b").alias("b2"), "rank", "before")
    inside = counts.join(F.broadcast(place), F.col("b") == F.col("b2"))
    upto = F.col("before") + F.sum("c").over(Window.orderBy("v"))
    return inside.withColumn("upto", upto).where("upto > rank").agg(F.min("v").alias(name))


def ranked_values(rows: DataFrame, value: Column, ranks: dict[str, Column]) -> DataFrame:
    """One row: by name the value at a rank (from 0, an expression of n, the number of non-null values) in sorted order, null where there is none.

    Values of any type that sorts are counted, then dealt to ranges; sums of ranges tell which range has a rank, and only that
    range's values, about PIECE, meet in a task. Nothing is assumed of how values are spread."""
    counts = materialised(rows.select(value.alias("v")).where("v is not null").groupBy("v").agg(F.count("*").alias("c")), "values")
    n, different = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    if different <= PIECE:
        part = counts.withColumn("part", F.lit(0))
    else:
        part = materialised(counts.repartitionByRange(-(-different // PIECE), "v").withColumn("part", F.spark_partition_id()), "ranges")
    before = F.coalesce(F.sum("c").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = part.groupBy("part").agg(F.sum("c").alias("c")).select("part", "c", before.alias("before"), F.lit(n).cast("long").alias("n"))
    wanted = F.explode(F.array(*(F.struct(F.lit(name).alias("name"), rank.cast("long").alias("rank")) for name, rank in ranks.items())))
    places = places.select("part", "c", "before", wanted.alias("w")).select("part", "c", "before", "w.*").where("rank >= before AND rank < before + c")
    inside = part.join(F.broadcast(places.drop("c")), "part")  # a row a rank
    upto = F.col("before") + F.sum("c").over(Window.partitionBy("name").orderBy("v"))
    found = inside.withColumn("upto", upto).where("upto > rank")
    return found.agg(*(F.min(F.when(F.col("name") == name, F.col("v"))).alias(name) for name in ranks))


def median_length(rows: DataFrame, text: str = "text") -> DataFrame:
    """The upper median of lengths, a null text having none."""
    size = F.length(F.coalesce(F.col(text), F.lit("")))
    return order_statistic(rows, size, F.floor(size / 256), F.floor(F.col("n") / 2), "median_chars")


def twentieth(rows: DataFrame, time: Column) -> DataFrame:
    """The time at a twentieth from the oldest, of ISO strings (which sort as times do); very many may lie in one hour."""
    return ranked_values(rows, F.nullif(time, F.lit("")), {"twentieth": F.floor(F.col("n") / 20)})


def inversions(rows: DataFrame, age: Column, ordinal: str, feed: list[str]) -> DataFrame:
    """By feed: ages that can be read, and how many are smaller than the one before, and the share of these in percent."""
    read = rows.select(*feed, ordinal, age_seconds(age).alias("s"))
    out = segments.falls(read, "s", ordinal, feed).select(*feed, F.col("n").alias("ages"), F.col("falls").alias("inversions"))
    return out.withColumn("inversion_percent", F.coalesce(F.try_divide(100.0 * F.col("inversions"), F.col("ages")), F.lit(0.0)))


def streak_stop(rows: DataFrame, past: Column, ordinal: str, feed: list[str], k: int) -> DataFrame:
    """By feed: the first row at which the last k rows, itself included, are all past."""
    out = segments.first_run(rows.select(*feed, ordinal, past.alias("past")), "past", ordinal, feed, k)
    return out.withColumnRenamed("at", "stops_at")


def stuck_cycles(rows: DataFrame, size: str, ordinal: str, feed: list[str]) -> DataFrame:
    """By feed and row: how many rows have passed since size last grew."""
    return segments.since_growth(rows, size, ordinal, feed, "stuck")


def tail(rows: DataFrame, value: str, ordinal: str, feed: list[str], n: int) -> DataFrame:
    """By feed: the last n values that aren't null, looking back 3 * n + 1 rows at most (the look-back is the feature)."""
    back = Window.partitionBy(*feed).orderBy(F.desc(ordinal))
    near = rows.withColumn("_back", F.row_number().over(back)).where(F.col("_back") <= 3 * n + 1).where(F.col(value).isNotNull())
    return near.withColumn("_kept", F.row_number().over(back)).where(F.col("_kept") <= n).drop("_back", "_kept")


def unit_histogram(rows: DataFrame, age: Column, ordinal: str) -> DataFrame:
    """unit, n, first (the first row that has it): the most frequent first, ties in the order of first."""
    out = rows.groupBy(age_unit(age).alias("unit")).agg(F.count("*").alias("n"), F.min(ordinal).alias("first"))
    return out.orderBy(F.desc("n"), "first")


def repeats(rows: DataFrame, keys: list[str], body: str) -> DataFrame:
    """One row: n, different keys, repeats (rows beyond the first of a key) and rows whose body is empty. Keys are counted in groups, so one that very many rows share is combined early."""
    by_key = rows.groupBy(*keys).agg(F.count("*").alias("c"))
    return by_key.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
        F.count("*").alias("unique_keys"),
        F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("repeats"),
        F.coalesce(F.sum(F.when(F.col(body) == "", F.col("c")).otherwise(0)), F.lit(0)).alias("empty_bodies"),
    )


def distinct_with_null(value: Column) -> Column:
    """Distinct values, null being one."""
    return F.count_distinct(value) + F.coalesce(F.max(value.isNull().cast("int")), F.lit(0))


def lengths(rows: DataFrame, text: str = "text") -> DataFrame:
    size = F.length(F.coalesce(F.col(text), F.lit("")))
    return rows.agg(F.min(size).alias("min_chars"), F.max(size).alias("max_chars"), F.count_if(size >= CLAMP - NEAR).alias("near_clamp"))


@dataclass(frozen=True)
class Measure:
    """A number of a batch's report, added up in two steps: over the rows of a key, then over keys."""

    name: str
    of_key: Column
    over_keys: Column


def counted(name: str, what: Column) -> Measure:
    """How many rows it holds for."""
    return Measure(name, F.count_if(what), F.coalesce(F.sum(name), F.lit(0)))


def least(name: str, value: Column) -> Measure:
    return Measure(name, F.min(value), F.min(name))


def greatest(name: str, value: Column) -> Measure:
    return Measure(name, F.max(value), F.max(name))


def measures(body: str, text: str, invalid: Column) -> list[Measure]:
    """What repeats() and lengths() tell, and rows that a rule (the bucket of the first that failed) rejects, by the keys of repeats()."""
    size = F.length(F.coalesce(F.col(text), F.lit("")))
    return [
        Measure("n", F.count("*"), F.coalesce(F.sum("n"), F.lit(0))), Measure("unique_keys", F.lit(1), F.count("*")), Measure("repeats", F.count("*") - 1, F.coalesce(F.sum("repeats"), F.lit(0))),
        counted("empty_bodies", F.col(body) == ""), least("min_chars", size), greatest("max_chars", size), counted("near_clamp", size >= CLAMP - NEAR), counted("invalid", invalid.isNotNull()),
    ]


def summary(rows: DataFrame, keys: list[str], of: list[Measure]) -> DataFrame:
    """One row with every measure, by one read of the rows and one shuffle of a row a key and task."""
    return rows.groupBy(*keys).agg(*(m.of_key.alias(m.name) for m in of)).agg(*(m.over_keys.alias(m.name) for m in of))


def saved_first(rows: DataFrame, keys: list[str], ordinal: list[str], of: list[Measure], name: str) -> tuple[DataFrame, DataFrame]:
    """The first row of each key as a table in the shared folder, and one row with every measure of all rows, both of one read.

    The aggregate that finds a key's first row adds up its measures; they are observed where the table is written, after the
    last shuffle, so a task that is repeated for a lost executor is counted once."""
    kept = first_with(rows, keys, ordinal, {m.name: m.of_key for m in of})
    totals = [m.over_keys.alias(m.name) for m in of]
    seen = Observation()
    table = materialised(kept.observe(seen, *totals).select("_first.*"), name)
    kind = kept.agg(*totals).schema
    return table, rows.sparkSession.createDataFrame([tuple(seen.get[f.name] for f in kind)], kind)


def beside(*reports: DataFrame) -> DataFrame:
    """One-row reports as one row."""
    out = reports[0].withColumn("_1", F.lit(1))
    for r in reports[1:]:
        out = out.join(r.withColumn("_1", F.lit(1)), "_1")
    return out.drop("_1")


def gates(report: DataFrame) -> DataFrame:
    """report with a column for each gate and the verdict; needs n, invalid, empty_bodies, repeats, near_clamp, ages and inversions. A batch without rows fails."""
    c = F.col
    failed = {
        "no_rows": c("n") == 0,
        "invalid_rows": c("invalid") > 0,
        "empty_rows": c("empty_bodies") > 0,
        "repeating": (c("n") >= ENOUGH) & (c("repeats") > 0.9 * c("n")),
        "clamped": c("near_clamp") > F.greatest(F.lit(3.0), 0.05 * c("n")),
        "disordered": (c("ages") >= ENOUGH) & (100.0 * c("inversions") > 10.0 * c("ages")),
    }
    out = report
    for name, f in failed.items():
        out = out.withColumn(name, F.coalesce(f, F.lit(False)))
    ok = F.lit(True)
    for name in failed:
        ok = ok & ~c(name)
    return out.withColumn("passed", ok)
