"""Keep-first dedup within a batch and against history."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.textops import letters_key


def post_key(author: Column, text: Column) -> list[Column]:
    """The columns that two captures of one post share."""
    return [F.coalesce(author, F.lit("")).alias("author_key"), letters_key(text).alias("body_key")]


def _named(column: str) -> Column:
    return F.col(f"`{column}`")


def keep_first(rows: DataFrame, keys: list[str], ordinal: list[str]) -> DataFrame:
    """Of the rows of each key, the first by ordinal, and only one: rows that tie on ordinal are told apart by a hash of their other columns (maps and variants, which have none, left out); rows that tie on that too are alike. Null keys are equal.

    One aggregate carries the rows themselves, so a key that very many rows share is combined before the shuffle, and rows are shuffled once."""
    return first_with(rows, keys, ordinal, {}).select("_first.*")


def first_with(rows: DataFrame, keys: list[str], ordinal: list[str], more: dict[str, Column]) -> DataFrame:
    """_first, the row that keep_first keeps, and beside it aggregates of all rows of its key."""
    plain = [f.name for f in rows.schema.fields if not re.search("map<|variant", f.dataType.simpleString())]
    order = F.struct(*(F.col(o) for o in ordinal), F.xxhash64(*map(_named, plain)).alias("_tie"))
    return rows.groupBy(*map(_named, keys)).agg(F.min_by(F.struct(*map(_named, rows.columns)), order).alias("_first"), *(c.alias(name) for name, c in more.items())).select("_first", *more)


def ranked_first(rows: DataFrame, keys: list[str], ordinal: list[str]) -> DataFrame:
    """As keep_first, by a window. Spark limits each group before the shuffle, so a key that very many rows share sends one row a task; of rows that tie on ordinal one stays, any."""
    w = Window.partitionBy(*keys).orderBy(*ordinal)
    return rows.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def against_history(rows: DataFrame, history: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key history doesn't have. There is no cut by age: late rows are new rows."""
    known = history.select(*(F.col(k).alias(f"_{k}") for k in keys)).distinct()
    on = F.lit(True)
    for k in keys:
        on = on & rows[k].eqNullSafe(known[f"_{k}"])
    return rows.join(known, on, "left_anti")


def save_batch(batch: DataFrame, history: DataFrame, keys: list[str], ordinal: list[str]) -> DataFrame:
    """What a run adds: new against history first, which shrinks what is then ranked."""
    return keep_first(against_history(batch, history, keys), keys, ordinal)


def save_report(batch: DataFrame, history: DataFrame, keys: list[str], ordinal: list[str]) -> DataFrame:
    """kept, skipped and history size (distinct keys) in one row."""
    kept = save_batch(batch, history, keys, ordinal).agg(F.count("*").alias("kept"))
    total = batch.agg(F.count("*").alias("total"))
    size = history.select(*keys).distinct().agg(F.count("*").alias("history_keys"))
    one = F.lit(1)  # each side is one row
    joined = kept.withColumn("_1", one).join(total.withColumn("_1", one), "_1").join(size.withColumn("_1", one), "_1")
    return joined.select("kept", (F.col("total") - F.col("kept")).alias("skipped_dup"), "history_keys")
