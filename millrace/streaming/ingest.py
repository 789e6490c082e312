"""Incremental ingest: a file stream whose checkpoint remembers what was read, and a sink that dedups by content.

There is no watermark: late rows are new rows. State is the history table itself, so it doesn't grow in the
stream, and a batch that is replayed adds nothing. With an index of its keys a batch reads only buckets of keys that it
may hit, not the history.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators import dedup
from ..operators.history import KeyIndex
from ..sources.shared import materialised


def history_or_none(spark: SparkSession, table: str, schema: StructType) -> DataFrame | None:
    """The table as it is now, or none before the first append."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(table)
    there = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    return spark.read.schema(schema).parquet(table) if there else None


def history_or_empty(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """The table as it is now, or no rows before the first append."""
    found = history_or_none(spark, table, schema)
    return spark.createDataFrame([], schema) if found is None else found


def open_stream(spark: SparkSession, path: str, schema: str | StructType, kind: str = "parquet", max_files: int | None = None) -> DataFrame:
    """Files as a stream; with max_files no batch has more, and what is left waits for the next batch."""
    reader = spark.readStream.format(kind).schema(schema)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).load(path)


def ingest(
    stream: DataFrame, table: str, checkpoint: str, keys: list[str], ordinal: list[str], prepare: Callable[[DataFrame], DataFrame] = lambda df: df, gate: Callable[[DataFrame], None] | None = None,
    index: KeyIndex | None = None,
) -> None:
    """Reads all that is new, then stops. Of each batch, prepared and passed by the gate (which raises to stop the run, leaving the batch unread), rows of new keys are appended to the table, the first of each key."""

    def save(batch: DataFrame, number: int) -> None:
        rows = prepare(batch).persist()
        try:
            if gate is not None:
                gate(rows)
            if index is None:
                known = history_or_empty(rows.sparkSession, table, rows.schema)
                dedup.save_batch(rows, known, keys, ordinal).write.mode("append").parquet(table)
            else:
                index.begin(history_or_none(rows.sparkSession, table, rows.schema))
                new = materialised(dedup.keep_first(index.unseen(rows), keys, ordinal), "new")
                new.write.mode("append").parquet(table)
                index.add(new)
                index.end()
        finally:
            rows.unpersist()

    query = stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
