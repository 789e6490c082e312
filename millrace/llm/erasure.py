"""Erasure that cascades over stored tables: sorted files, victims found by joins, and only the files that hold some rewritten.

`store` sorts a table by a checksum of its owner and then by all columns, and cuts it into files of equal numbers of
consecutive rows: rows are dealt by ranges, prefix sums of the partitions' counts give every row its rank, and the rank its file.
`erase` counts a table's victims file by file (left-semi join), writes the survivors of the affected files again
(left-anti join) in the order that they had, and removes files of which nothing is left. All others stay as they are.

A file is a folder `file_no=K` with one Parquet file, so the rewritten ones replace theirs when the job commits
and not before: a job that fails, or loses executors, leaves the table as it was. A file is written by one task, as a stream.

A key that very many rows share (an owner, a sale) would be one task's in a shuffled join. Keys with over a
thousandth of a table's rows, at most a thousand, are looked up on their own and decided by a list; all others are joined by
shuffles. Null keys are nobody's: they match nothing and are never erased. Equal rows are all kept, or all erased. An
empty table has no files. Columns may have any names; the folder's own, file_no, gives way to theirs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, LongType

from .common import free_name, small_batches
from .ranks import ranked

#: Files of a table, about; a key is hot above this share of a table's rows.
FILES, HOT = 350, 1000


def _at(column: str) -> Column:
    return F.col(f"`{column}`")


def owner_crc(owner: Column) -> Column:
    """The checksum of a decimal id; of the empty string for none."""
    return F.crc32(F.coalesce(owner.cast("string"), F.lit("")))


@dataclass(frozen=True)
class Stored:
    """A table in files: its folder, schema, rows in all, rows of a file, and what the folders of files are called."""

    spark: SparkSession
    path: str
    schema: StructType
    n: int
    per_file: int
    file: str

    def rows(self) -> DataFrame:
        """The table as it is now, with the number of each row's file. Its files are listed at every call."""
        return self.spark.read.schema(StructType([*self.schema.fields, StructField(self.file, LongType())])).parquet(self.path)

    def size_of(self, file_no: int) -> int:
        """Rows that a file had at first."""
        return min(self.per_file, self.n - file_no * self.per_file)


def _in_files(rows: DataFrame, file: str, order: list[str], schema: StructType, path: str, mode: str) -> None:
    """One file for each number, with its rows in order. The count of partitions is given, as adaptive execution would else let few tasks write all files."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, F.col(f"`{file}`")).sortWithinPartitions(file, *order)
    dealt.select(*map(_at, schema.names), _at(file)).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(file).parquet(path)


def store(rows: DataFrame, crc: Column, tie: str, path: str, files: int = FILES) -> Stored:
    """Writes rows (without tie, a column of different numbers that the scan gave) in the order of crc and all columns, nulls first; crc may use a column that goes with tie, if it is named as `<tie>_...`."""
    kept = [f for f in rows.schema.fields if f.name != tie and not f.name.startswith(f"{tie}_")]
    schema = StructType(kept)
    taken = rows.withColumn(f"{tie}_crc", crc)
    file, rank = free_name(rows, "file_no"), f"{tie}_rank"
    sorted_, n = ranked(taken.select(*map(_at, schema.names), f"{tie}_crc", tie), [F.col(f"{tie}_crc"), *map(_at, schema.names)], tie, rank)
    per_file = 1 + n // files
    _in_files(sorted_.withColumn(file, F.floor(F.col(rank) / per_file)), file, [rank], schema, path, "overwrite")
    return Stored(rows.sparkSession, path, schema, n, per_file, file)


def hot_keys(rows: DataFrame, key: str, total: int | None = None) -> list:
    """Keys that more than one in HOT of rows have, so less than HOT of them; counted before they are shuffled."""
    n = rows.count() if total is None else total
    return [r[0] for r in rows.where(_at(key).isNotNull()).groupBy(_at(key)).count().where(F.col("count") * HOT > n).collect()]


def _split(rows: DataFrame, key: str, victims: DataFrame, hot: list) -> tuple[DataFrame, Column, DataFrame]:
    """What is joined by a shuffle, whether a row of a hot key is a victim, and the victims to join with. The few hot victims come to the driver."""
    name = victims.columns[0]
    found = [r[0] for r in victims.where(_at(name).isin(hot)).distinct().collect()] if hot else []
    cold = _at(key).isNotNull() & ~_at(key).isin(hot) if hot else _at(key).isNotNull()
    return rows.where(cold), _at(key).isin(found) if found else F.lit(False), victims.where(_at(name).isNotNull()).select(_at(name).alias("_victim")).hint("merge")


def among(rows: DataFrame, key: str, victims: DataFrame, hot: list) -> DataFrame:
    """Rows whose key is a victim's."""
    cold, hit, v = _split(rows, key, victims, hot)
    return cold.join(v, _at(key) == F.col("_victim"), "left_semi").unionByName(rows.where(hit))


def without(rows: DataFrame, key: str, victims: DataFrame, hot: list) -> DataFrame:
    """Rows whose key is no victim's."""
    cold, hit, v = _split(rows, key, victims, hot)
    others = _at(key).isNull() | (_at(key).isin(hot) & ~hit) if hot else _at(key).isNull()
    return cold.join(v, _at(key) == F.col("_victim"), "left_anti").unionByName(rows.where(others))


def with_owner(rows: DataFrame, key: str, owners: DataFrame, name: str) -> DataFrame:
    """rows with the column name of owners (key, name; a key has one row), null where there is none; hot keys are joined by a broadcast of as many rows at most."""
    hot = hot_keys(rows, key)
    of = owners.select(_at(key).alias("_key"), _at(name))
    cold = _at(key).isNotNull() & ~_at(key).isin(hot) if hot else _at(key).isNotNull()
    out = rows.where(cold).join(of.hint("merge"), _at(key) == F.col("_key"), "left").drop("_key")
    few = of.where(F.col("_key").isin(hot)) if hot else of.limit(0)
    return out.unionByName(rows.where(~cold).join(F.broadcast(few), _at(key) == F.col("_key"), "left").drop("_key"))


def erase(table: Stored, key: str, victims: DataFrame) -> dict[int, int]:
    """Erases the rows whose key is in victims (one column) from their files; returns how many each affected file has lost. The numbers of files, at most FILES + 1, are all that comes to the driver, save hot keys."""
    rows = table.rows()
    hot = hot_keys(rows, key, table.n)
    lost = among(rows.select(_at(key), _at(table.file)), key, victims, hot).groupBy(_at(table.file)).count().collect()
    erased = {int(r[0]): int(r[1]) for r in lost}
    left = [f for f, n in erased.items() if n < table.size_of(f)]
    if left:
        place = free_name(rows, "_place")
        affected = rows.where(_at(table.file).isin(left)).select("*", F.col("_metadata.row_index").alias(place))
        _in_files(without(affected, key, victims, hot), table.file, [place], table.schema, table.path, "overwrite")
    where = table.spark._jvm.org.apache.hadoop.fs.Path(table.path)
    store_ = where.getFileSystem(table.spark._jsc.hadoopConfiguration())
    for f in erased.keys() - set(left):
        store_.delete(table.spark._jvm.org.apache.hadoop.fs.Path(f"{table.path}/{table.file}={f}"), True)
    return erased


def described(table: Stored, amount: str, erased: dict[int, int]) -> DataFrame:
    """A row for each file as it is read back now: file_no, n_rows, n_erased, cents, rewritten, ids_sha256, columns, path. A file's rows are read in their order by one task, as a stream."""
    spark = table.spark
    small_batches(spark)
    first = table.schema.names[0]
    cents = F.coalesce(F.floor(100 * _at(amount) + F.lit(0.5)), F.lit(0)).cast("long")
    rows = table.rows().select(_at(table.file).alias("file_no"), F.col("_metadata.row_index").alias("place"), F.col("_metadata.file_path").alias("path"), F.coalesce(_at(first).cast("string"), F.lit("")).alias("id"), cents.alias("cents"))
    rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file_no").sortWithinPartitions("file_no", "place").drop("place")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, path, n, total, digest = None, None, 0, 0, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"file_no": pa.array([file], pa.int64()), "n_rows": pa.array([n], pa.int64()), "cents": pa.array([total], pa.int64()), "ids_sha256": [digest.hexdigest()], "path": [path]})

        for batch in batches:
            numbers, ids, sums, paths = (batch.column(c).to_pylist() for c in ("file_no", "id", "cents", "path"))
            at = 0
            while at < len(numbers):
                upto = at
                while upto < len(numbers) and numbers[upto] == numbers[at]:
                    upto += 1
                if numbers[at] != file:
                    if n:
                        yield row()
                    file, path, n, total, digest = numbers[at], paths[at], 0, 0, hashlib.sha256()
                digest.update((("," if n else "") + ",".join(ids[at:upto])).encode())
                n, total, at = n + upto - at, total + sum(sums[at:upto]), upto
        if n:
            yield row()

    found = rows.select("file_no", "path", "id", "cents").mapInArrow(digests, "file_no long, n_rows long, cents long, ids_sha256 string, path string")
    gone = spark.createDataFrame(list(erased.items()), "file_no long, n_erased long")
    out = found.join(F.broadcast(gone), "file_no", "left")
    n_erased = F.coalesce("n_erased", F.lit(0).cast("long"))
    return out.select("file_no", "n_rows", n_erased.alias("n_erased"), "cents", (n_erased > 0).alias("rewritten"), "ids_sha256", F.lit(",".join(table.schema.names)).alias("columns"), "path")


#: Masters whose checksum this divides are victims.
MASTERS_MOD = 400
#: What is summed for each table.
AMOUNTS = {"clients": "balance", "clicks": "value", "sales": "total", "sale_lines": "amount"}


def busiest_master(clients: DataFrame, clicks: DataFrame) -> int | None:
    """The master whose clients together have most clicks; of several the smallest, null only without any master."""
    counted = clicks.where("client_id IS NOT NULL").groupBy("client_id").agg(F.count("*").alias("c"))
    pairs = clients.where("master_id IS NOT NULL").select("client_id", "master_id").distinct()
    by_master = pairs.join(counted, "client_id", "left").groupBy("master_id").agg(F.sum(F.coalesce("c", F.lit(0))).alias("c"))
    return by_master.agg(F.max_by("master_id", F.struct("c", -F.col("master_id")))).first()[0]


def erase_shop(tables: dict[str, DataFrame], folder: str, files: int = FILES) -> DataFrame:
    """Stores clients, clicks, sales and sale_lines in folder and erases the victim masters' clients, these clients' clicks and sales, and these sales' lines; a row for each file that is left, with table_name."""
    tied = {name: t.withColumn("_tie", F.monotonically_increasing_id()) for name, t in tables.items()}
    owners = tables["sales"].where("sale_id IS NOT NULL").groupBy("sale_id").agg(F.min("client_id").alias("_tie_owner"))
    tied["sale_lines"] = with_owner(tied["sale_lines"], "sale_id", owners, "_tie_owner")
    stored = {name: store(t, owner_crc(F.col("_tie_owner" if name == "sale_lines" else "client_id")), "_tie", f"{folder}/{name}", files) for name, t in tied.items()}
    master = busiest_master(tables["clients"], tables["clicks"])
    doomed = F.col("master_id").isNotNull() & ((F.crc32(F.col("master_id").cast("string")) % MASTERS_MOD == 0) | F.coalesce(F.col("master_id") == F.lit(master), F.lit(False)))
    victims = {"clients": tables["clients"].where(doomed).select("client_id", "master_id")}
    people = victims["clients"].where("client_id IS NOT NULL").select("client_id").distinct()
    sold = among(tables["sales"].select("client_id", "sale_id"), "client_id", people, hot_keys(tables["sales"], "client_id", stored["sales"].n)).where("sale_id IS NOT NULL").select("sale_id").distinct()
    masters = victims["clients"].select("master_id").distinct()
    out: DataFrame | None = None
    for name, key, gone in (("clients", "master_id", masters), ("clicks", "client_id", people), ("sales", "client_id", people), ("sale_lines", "sale_id", sold)):
        erased = erase(stored[name], key, gone)
        found = described(stored[name], AMOUNTS[name], erased).select(F.lit(name).alias("table_name"), "*")
        out = found if out is None else out.unionByName(found)
    return out
