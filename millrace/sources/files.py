"""Pages, JSON lines and run files: reading, staging and appending."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.ages import iso, stamped
from ..functions.textops import is_blank, permalink

#: Splits of files whose counts are broadcast at most, of about 200 bytes each.
FEW_SPLITS = 200_000
POST = "author_profile_url string, author_name string, text string, post_relative_age string, post_time_iso string, scraped_at string"
MESSAGE = "channel string, channel_title string, message_id bigint, text string, posted_at string, scraped_at string"


def scan_pages(spark: SparkSession, path: str, pattern: str = "*.html") -> DataFrame:
    """page (its path), html (bytes that aren't UTF-8 are replaced), captured_at (when the file was last changed)."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return raw.select(F.col("path").alias("page"), F.make_valid_utf8(F.col("content").cast("string")).alias("html"), F.col("modificationTime").alias("captured_at"))


def newest(files: DataFrame, path: str = "page", time: str = "captured_at") -> DataFrame:
    """One row: the file that was changed last, and when. Contents aren't read."""
    return files.agg(F.max_by(path, time).alias(path), F.max(time).alias(time))


def unprocessed(pages: DataFrame, runs: DataFrame, time: str = "captured_at") -> DataFrame:
    """Pages captured after the last run; runs has names of run files. A last name without a time blocks nothing."""
    last = runs.agg(F.max("name").alias("name")).select(stamped(F.col("name")).alias("_last"))
    return pages.join(F.broadcast(last), F.col("_last").isNull() | (F.col(time) > F.col("_last"))).drop("_last")


def fresh(files: DataFrame, now: Column, max_age_seconds: int = 1800, time: str = "captured_at") -> DataFrame:
    """Files that aren't older than so many seconds."""
    return files.where(F.timestamp_diff("SECOND", F.col(time), now) <= max_age_seconds)


def collected(files: DataFrame, now: Column, max_age_seconds: int = 1800, force: bool = False, path: str = "page", time: str = "captured_at") -> DataFrame:
    """The one page to take over: the file that was changed last, if it isn't older than so many seconds (or with force); else no row."""
    last = newest(files, path, time).where(F.col(path).isNotNull())
    return last if force else fresh(last, now, max_age_seconds, time)


def _there(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    return found is not None and len(found) > 0


def ordered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file (its name), ordinal (the line's number in its file, from 0), line: a large file is read in many tasks.

    A split of a file knows where it starts, and its lines come in order, so a line's number is that in its split and the
    lines of the splits before it: counts by split, a row each, are summed up within files and joined back. They are
    broadcast while they are few (a file has one split, and one more for each full share of the bytes that tasks read)."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_id"), F.col("value").alias("line")
    )
    splits = lines.groupBy("_file", "_start").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    earlier = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("_file", "_start", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    if len(lines.inputFiles()) + lines.rdd.getNumPartitions() <= FEW_SPLITS:
        splits = F.broadcast(splits)
    return lines.join(splits, ["_file", "_start"]).select("file", (F.col("_before") + F.col("_id") - F.col("_first")).alias("ordinal"), "line")


def json_lines(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """file, ordinal (the line's number in its file, from 0, blank lines counted), the schema's columns and keys (those that the line has). Blank lines are skipped; a malformed line fails the read, or with strict off gives nulls. A path that isn't there has no lines."""
    if not _there(spark, path):
        none = spark.createDataFrame([], schema)
        return none.select(F.lit("").alias("file"), F.lit(0).cast("long").alias("ordinal"), "*", F.array().cast("array<string>").alias("keys"))
    lines = ordered_lines(spark, path).where(~is_blank(F.col("line")))
    row = F.from_json("line", schema, {"mode": "FAILFAST" if strict else "PERMISSIVE"})
    return lines.select("file", "ordinal", row.alias("_row"), F.json_object_keys("line").alias("keys")).select("file", "ordinal", "_row.*", "keys")


def history(spark: SparkSession, folder: str, schema: str = POST) -> DataFrame:
    """Every run file of a folder, not validated again; run is the file's name. A folder that isn't there has no runs."""
    if not _there(spark, f"{folder.rstrip('/')}/posts_*.jsonl"):
        return spark.createDataFrame([], schema).withColumn("run", F.lit(""))
    return spark.read.schema(schema).option("pathGlobFilter", "posts_*.jsonl").json(folder).withColumn("run", F.col("_metadata.file_name"))


def post_lines(spark: SparkSession, path: str, max_days: int = 30) -> DataFrame:
    """json_lines of posts, times read, with outcome: record, or the first rule that a line breaks (a missing or an unknown key breaks one too)."""
    return _judged(json_lines(spark, path, POST), rules.POST_FIELDS, ("post_time_iso", "scraped_at"), rules.post_rules(max_days))


def message_lines(spark: SparkSession, path: str, base: str = "https://t.me") -> DataFrame:
    """json_lines of channel messages, times read, with url (the permalink) and outcome."""
    rows = _judged(json_lines(spark, path, MESSAGE), rules.MESSAGE_FIELDS, ("posted_at", "scraped_at"), rules.message_rules(), ("channel_title",))
    return rows.withColumn("url", permalink(base, F.col("channel"), F.col("message_id")))


def _judged(rows: DataFrame, fields: list[str], times: tuple[str, ...], checks: list[rules.Rule], optional: tuple[str, ...] = ()) -> DataFrame:
    needed = [f for f in fields if f not in optional]
    rows = rows.withColumns({t: F.try_to_timestamp(t) for t in times})
    every = [rules.Rule("missing", missing_keys(needed)), *checks, rules.extra_keys(F.col("keys"), fields)]
    return rows.withColumn("outcome", F.coalesce(rules.first_failure(every), F.lit("record")))


def missing_keys(fields: list[str]) -> Column:
    """Whether a row of json_lines lacks a field."""
    return ~F.forall(F.array(*map(F.lit, fields)), lambda f: F.array_contains("keys", f))


def write_lines(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines; times as ISO 8601 in UTC, letters as they are, nulls kept."""
    times = {c for c, t in rows.dtypes if t == "timestamp"}
    rows.select(*(iso(F.col(c)).alias(c) if c in times else F.col(c) for c in rows.columns)).write.mode(mode).option("ignoreNullFields", "false").json(path)


def append_run(rows: DataFrame, table: str, stamp: str, staging: str | None = None) -> int:
    """Adds rows as the partition run_ts=stamp of a Parquet table; nothing is written if there are none. The same stamp again replaces its own rows, so a run may be repeated. The staging path goes once the rows are saved. Returns how many there are."""
    rows = rows.persist()
    try:
        if n := rows.count():
            rows.withColumn("run_ts", F.lit(stamp)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_ts").parquet(table)
        if staging is not None:
            spark = rows.sparkSession
            where = spark._jvm.org.apache.hadoop.fs.Path(staging)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        return n
    finally:
        rows.unpersist()
