"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import new_folder
from ..sources.workers import bounded_batches as small_batches
from ..sources.workers import give_back

#: The white space of the contracts: space, and tab to carriage return.
SPACE = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

__all__ = ["LOWER", "SPACE", "UPPER", "ascii_lower", "fits", "free_name", "give_back", "small_batches", "table", "unit_hash", "written", "written_alone"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """A name for a helper column that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, reread: a cut of the lineage that outlives executors."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_alone(df: DataFrame, name: str, bucket: str | None = None) -> DataFrame:
    """As written, bucketed by a column if asked, so that joins on it don't shuffle the table; and the shuffle files of this one write go when it ends, not when the driver happens to collect its garbage. Only for a df that isn't run again."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        if bucket is None:
            return written(df, name)
        path, given = new_folder(df.sparkSession, name), f"millrace_{uuid.uuid4().hex}"
        buckets = min(100_000, int(conf.get("spark.sql.shuffle.partitions")))  # that many is the limit of a bucketed table
        df.write.format("parquet").option("path", path).bucketBy(buckets, bucket).saveAsTable(given)
        return df.sparkSession.table(given)
    finally:
        conf.set(key, before)


def ascii_lower(text: Column) -> Column:
    """A-Z lowered, all else as it is."""
    return F.translate(text, UPPER, LOWER)


def unit_hash(*cols: Column) -> Column:
    """A number in [0, 1) that depends on the columns alone."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 52)) / F.lit(float(1 << 52))


def fits(df: DataFrame, rows: int) -> bool:
    """Whether df has at most so many rows; reads no more than that."""
    return df.limit(rows + 1).count() <= rows
