"""An index of the keys that a history has, so that a batch reads only the part of it that it may hit.

Keys are dealt by a hash to cells, and cells to buckets. Of every run the index keeps, by bucket, the keys themselves and a
blocked Bloom filter: 512 bits a cell, of which a key sets HITS. A batch meets the filters first, by an equi-join on the
cell; only keys that may be there go on, and only their buckets' keys are read. A key that isn't in the history passes
its filter about once in a hundred times while cells hold no more than KEYS_A_CELL keys; beyond, more pass and
more is read, but results are the same. Filters take some 2 bytes a key.

Adding keys twice changes nothing. `begin` and `end` stand around the writes to the history; a history that was
written by a run which ended in between is caught up with at the next `begin`. Nulls are keys like any other, equal to one another.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import materialised

WORDS, HITS, KEYS_A_CELL = 8, 6, 40
#: Seconds by which clocks of those who write files may differ.
CLOCKS = 3600


@dataclass(frozen=True)
class KeyIndex:
    """Of the keys (columns, name to type) in a folder. capacity: keys that filters are made for; buckets and capacity hold for the index's life."""

    spark: SparkSession
    path: str
    keys: dict[str, str]
    capacity: int = 10_000_000
    buckets: int = 256

    def _place(self, rows: DataFrame) -> DataFrame:
        """rows with _cell, _bucket and the bits that the key sets, _w0 to _w7."""
        names = [F.col(f"`{k}`") for k in self.keys]
        cells = max(self.buckets, -(-self.capacity // KEYS_A_CELL))
        out = rows.withColumns({"_cell": F.pmod(F.xxhash64(*names, F.lit(1)), F.lit(cells)), "_bits": F.xxhash64(*names, F.lit(2))})
        at = [F.shiftrightunsigned("_bits", 9 * i).bitwiseAND(F.lit(511)).cast("int") for i in range(HITS)]

        def word(w: int) -> Column:
            own = [F.when(F.shiftright(x, 6) == w, F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(63))).otherwise(F.lit(0).cast("long")) for x in at]
            return reduce(lambda a, b: a.bitwiseOR(b), own)

        return out.withColumns({f"_w{w}": word(w) for w in range(WORDS)}).withColumn("_bucket", F.pmod("_cell", F.lit(self.buckets)).cast("int")).drop("_bits")

    def _fs(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _stored(self, part: str) -> DataFrame | None:
        where, fs = self._fs(f"{self.path}/{part}")
        if not fs.exists(where):
            return None
        columns = ", ".join(f"`{k}` {t}" for k, t in self.keys.items()) if part == "keys" else ", ".join(["_cell long", *(f"_w{w} long" for w in range(WORDS))])
        return self.spark.read.schema(f"{columns}, _bucket int").parquet(f"{self.path}/{part}")

    def add(self, rows: DataFrame) -> None:
        """The keys of rows, each once. Keys are there before the filters that lead to them."""
        found = materialised(self._place(rows.select(*(F.col(f"`{k}`").cast(t).alias(k) for k, t in self.keys.items())).distinct()), "keys")
        found.select(*(F.col(f"`{k}`") for k in self.keys), "_bucket").repartition("_bucket").write.mode("append").partitionBy("_bucket").parquet(f"{self.path}/keys")
        cells = found.groupBy("_bucket", "_cell").agg(*(F.bit_or(f"_w{w}").alias(f"_w{w}") for w in range(WORDS)))
        cells.repartition("_bucket").write.mode("append").partitionBy("_bucket").parquet(f"{self.path}/filters")

    def maybe(self, rows: DataFrame) -> DataFrame | None:
        """The different keys of rows that pass a filter, with their _bucket; None without any filter."""
        filters = self._stored("filters")
        if filters is None:
            return None
        probes = self._place(rows.select(*(F.col(f"`{k}`") for k in self.keys)).distinct())
        given = filters.select("_bucket", "_cell", *(F.col(f"_w{w}").alias(f"_f{w}") for w in range(WORDS)))
        passes = reduce(lambda a, b: a & b, (F.col(f"_w{w}").bitwiseAND(F.col(f"_f{w}")) == F.col(f"_w{w}") for w in range(WORDS)))
        return probes.join(given, ["_bucket", "_cell"]).where(passes).select(*(F.col(f"`{k}`") for k in self.keys), "_bucket").distinct()

    def known(self, rows: DataFrame) -> DataFrame | None:
        """The keys of rows that the history has; None if no bucket needs to be read. The buckets' numbers, at most `buckets`, come to the driver."""
        passing = self.maybe(rows)
        if passing is None:
            return None
        passing = materialised(passing, "maybe")
        hit = [r[0] for r in passing.select("_bucket").distinct().collect()]
        if not hit:
            return None
        stored = self._stored("keys").where(F.col("_bucket").isin(hit)).select(*(F.col(f"`{k}`").alias(f"_{k}") for k in self.keys))
        return passing.drop("_bucket").join(stored, reduce(lambda a, b: a & b, (passing[k].eqNullSafe(stored[f"_{k}"]) for k in self.keys)), "left_semi")

    def unseen(self, rows: DataFrame) -> DataFrame:
        """Rows whose key the history doesn't have."""
        known = self.known(rows)
        if known is None:
            return rows
        old = known.select(*(F.col(f"`{k}`").alias(f"_{k}") for k in self.keys))
        return rows.join(old, reduce(lambda a, b: a & b, (rows[k].eqNullSafe(old[f"_{k}"]) for k in self.keys)), "left_anti")

    def begin(self, history: DataFrame | None) -> None:
        """Before the history is written. If the last run didn't come to its end, the keys of files since it began are added."""
        where, fs = self._fs(f"{self.path}/pending")
        if fs.exists(where):
            if history is not None:
                since = fs.getFileStatus(where).getModificationTime() / 1000 - CLOCKS
                self.add(history.where(F.unix_timestamp(F.col("_metadata.file_modification_time")) >= since))
        else:
            fs.create(where).close()

    def end(self) -> None:
        """After the history and the index are written."""
        where, fs = self._fs(f"{self.path}/pending")
        fs.delete(where, False)
