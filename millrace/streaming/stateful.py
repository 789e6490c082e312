"""Keep-first over a stream by keyed state: what was seen lies in the stream's state store, so no batch reads the history.

State is one mark a key, in RocksDB beside the executor and snapshotted into the checkpoint, from which a lost executor's
share is restored. There is no watermark and no expiry: late rows are new rows, so state grows with the different keys and
with nothing else. The sink is a Parquet table with a commit log of its own, so a batch that is replayed after a failure
is there once. Before the shuffle each Arrow batch keeps one row a key, so a key that very many rows share sends a row a batch.

Keys are dealt into BUCKETS groups, whose state is a map of marks by key: Spark starts a group by an Arrow batch and several
calls to the state server, which cost far more than looking up and marking a key. A lookup reads its key only, not the map.
A group holds a trigger's thinned rows of a bucket, so a first load of very many keys goes by files (open_stream's max_files).

Of rows of one key that come in one trigger the first by ordinal stays, of those that tie any one; over triggers the one that came first.
Null keys are equal, null ordinals come last. A stream without rows makes an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..sources.workers import bounded_batches

#: Groups that share out the keys. A checkpoint's state lies by them, so it can't be read with another number.
BUCKETS = 4096
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Keys as JSON must differ wherever keys differ.
_EXACT = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _bucketed(rows: DataFrame, keys: list[str], *kept: str) -> DataFrame:
    """The columns kept, with the keys as one text, _key, and its bucket."""
    keyed = rows.select(*(f"`{c}`" for c in kept), F.to_json(F.struct(*(f"`{k}`" for k in keys)), _EXACT).alias("_key"))
    return keyed.withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(BUCKETS)).cast("int"))


def _earliest(rows: pa.RecordBatch, ordinal: list[str]) -> pa.RecordBatch:
    """One row a key."""
    rows = rows.take(pc.sort_indices(rows, [(o, "ascending") for o in ordinal]))
    place = pa.table({"key": rows["_key"], "i": pa.array(range(len(rows)), pa.int64())})
    return rows.take(place.group_by("key").aggregate([("i", "min")])["i_min"].combine_chunks())


class FirstOfKey(StatefulProcessor):
    """Of a bucket's rows, gives the first of each key that has no mark yet, and marks it."""

    def __init__(self, ordinal: list[str], columns: list[str]):
        self.ordinal, self.columns = ordinal, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "key string", "seen boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first: dict[str, tuple[tuple, Row]] = {}
        for row in rows:
            values = (row[o] for o in self.ordinal)
            order = tuple((True, 0) if v is None or v != v else (False, v) for v in values)
            if (held := first.get(row["_key"])) is None or order < held[0]:
                first[row["_key"]] = order, row
        for k, (_, row) in first.items():
            if not self.seen.containsKey((k,)):
                self.seen.updateValue((k,), (True,))
                yield Row(**{c: row[c] for c in self.columns})

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.seen.updateValue((initialState["_key"],), (True,))

    def close(self) -> None:
        pass


def keep_first_stream(rows: DataFrame, keys: list[str], ordinal: list[str], history: DataFrame | None = None) -> DataFrame:
    """Of a streaming DataFrame, the first row of each key. history (at least the keys) counts as seen before; it is read once, in the first batch that a checkpoint has."""
    bounded_batches(rows.sparkSession)

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _earliest(batch, ordinal)

    keyed = _bucketed(rows, keys, *rows.columns)
    thinned = keyed.mapInArrow(thin, keyed.schema)
    seen = None if history is None else _bucketed(history, keys).distinct().groupBy("_bucket")
    return thinned.groupBy("_bucket").transformWithState(FirstOfKey(ordinal, rows.columns), rows.schema, "Append", "None", seen)


def ingest_first(stream: DataFrame, table: str, checkpoint: str, keys: list[str], ordinal: list[str], history: DataFrame | None = None):
    """Adds the first row of each new key of all that is new in the stream to the table, then stops; returns the query, whose progress tells what was read. The checkpoint holds the state, so it must stay with the table."""
    conf = stream.sparkSession.conf
    before = conf.get(_PROVIDER, None)
    conf.set(_PROVIDER, _ROCKS)
    try:
        out = keep_first_stream(stream, keys, ordinal, history)
        query = out.writeStream.format("parquet").outputMode("append").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        return query
    finally:
        conf.unset(_PROVIDER) if before is None else conf.set(_PROVIDER, before)
