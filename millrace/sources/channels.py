"""Channel messages by number: a data source that knows which numbers of which channel were read before.

An archive is a folder for each channel with JSON lines files named <first>-<last>.jsonl, the least and the greatest
message number in them, as an export leaves them; exports may overlap, come late or be repeated. What a stream has read is
kept as ranges of numbers by channel, so an export that overlaps an earlier one gives its new numbers only, one that comes
late gives all of its own, and one that is there twice gives nothing. Of files that share numbers the first by (first, last, path)
gives them; of lines in a file that share one, the first. A number that a file's
name covers and its lines lack counts as read: messages get no new numbers, so it was deleted. The driver sees names and sizes of
files, tasks see their lines, one file at a time; a task reads many small files, so tasks are as many as the bytes ask for, not as the files.

Batch reads take filters: a channel that isn't asked for isn't opened, nor is a file outside of the numbers asked for.
Files are opened by pyarrow, so the archive may lie in any store that it can open (local, hdfs, s3, gs). Other names than
these are passed over; an archive that isn't there has no messages.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from ..operators.dedup import keep_first
from .files import MESSAGE
from .workers import bounded_batches, ship

NAME = "channel_archive"
#: Rows of an Arrow batch that a task gives.
ROWS = 1000
#: Bytes that a task reads, or one file if it has more, and what opening a file counts as.
TASK_BYTES, OPEN_BYTES = 16 << 20, 64 << 10
_FILE = re.compile(r"(\d+)-(\d+)\.jsonl")
_LEAST, _GREATEST = 0, (1 << 63) - 1

Ranges = list[list[int]]
#: First and last number, path and bytes.
File = tuple[int, int, str, int]


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path, with or without a scheme, and the path in it."""
    path = re.sub(r"^file:/+", "/", path)
    return (fs.LocalFileSystem(), path) if "://" not in path else fs.FileSystem.from_uri(path)


def minus(ranges: Ranges, known: Ranges) -> Ranges:
    """The numbers of ranges that aren't in known; both sorted and apart, ends included."""
    out = []
    for low, high in ranges:
        for a, b in known:
            if b < low:
                continue
            if a > high:
                break
            if a > low:
                out.append([low, a - 1])
            low = b + 1
        if low <= high:
            out.append([low, high])
    return out


def union(ranges: Ranges) -> Ranges:
    """Sorted and apart; ranges that touch are one."""
    out: Ranges = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out


@dataclass
class Share(InputPartition):
    """A file and the numbers that it gives, and others that the same task reads after it."""

    path: str
    ranges: Ranges
    size: int = 0
    rest: list[Share] = field(default_factory=list)


def listing(folder: str) -> dict[str, list[File]]:
    """By channel its files, in order."""
    store, root = opened(folder)
    out: dict[str, list[File]] = {}
    for f in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
        if f.type == fs.FileType.File and (m := _FILE.fullmatch(f.base_name)):
            out.setdefault(unquote(f.path.split("/")[-2]), []).append((int(m[1]), int(m[2]), f.path, f.size or 0))
    return {channel: sorted(files) for channel, files in out.items()}


def shares(files: list[File], wanted: Ranges) -> Iterator[Share]:
    """Deals the wanted numbers of a channel to its files, each to the first that may have it."""
    for first, last, path, size in files:
        mine = minus([[first, last]], minus([[first, last]], wanted))
        if mine:
            yield Share(path, mine, size)
            wanted = minus(wanted, mine)


def tasks(given: Iterable[Share]) -> list[Share]:
    """The shares put together until a task has TASK_BYTES."""
    out: list[Share] = []
    left = 0
    for share in given:
        cost = share.size + OPEN_BYTES
        if out and cost <= left:
            out[-1].rest.append(share)
            left -= cost
        else:
            out.append(share)
            left = TASK_BYTES - cost
    return out


def _messages(store: fs.FileSystem, share: Share) -> Iterator[dict]:
    """The file's messages with numbers in its share, each number once, in the file's order."""
    seen = set()
    with store.open_input_stream(share.path) as raw:
        for line in _lines(raw):
            if not line.strip():
                continue
            row = json.loads(line)
            number = row["message_id"]
            if number in seen or not any(low <= number <= high for low, high in share.ranges):
                continue
            seen.add(number)
            yield row


def rows_of(folder: str, share: Share, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The messages of a task's files, file by file."""
    store, _ = opened(folder)
    kept, names = [], schema.names
    for part in (share, *share.rest):
        for row in _messages(store, part):
            kept.append({n: row.get(n) for n in names})
            if len(kept) == ROWS:
                yield pa.RecordBatch.from_pylist(kept, schema)
                kept = []
    if kept:
        yield pa.RecordBatch.from_pylist(kept, schema)


def _lines(stream) -> Iterator[bytes]:
    rest = b""
    while block := stream.read(1 << 20):
        *whole, rest = (rest + block).split(b"\n")
        yield from whole
    yield rest


class _Reader:
    def __init__(self, folder: str):
        self.folder = folder

    def read(self, partition: Share | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark reads where there are no partitions
            return iter(())
        text = [(n, pa.int64() if n == "message_id" else pa.string()) for n in (c.split()[0] for c in MESSAGE.split(", "))]
        return rows_of(self.folder, partition, pa.schema(text))


class ArchiveReader(_Reader, DataSourceReader):
    """All messages, or those of the channels and numbers that filters ask for."""

    def __init__(self, folder: str):
        super().__init__(folder)
        self.channels: set[str] | None = None
        self.low, self.high = _LEAST, _GREATEST

    def pushFilters(self, filters) -> Iterator:
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column == "channel" and isinstance(f, EqualTo | In):
                asked = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.channels = asked if self.channels is None else self.channels & asked
            elif column == "message_id" and isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual | LessThan | LessThanOrEqual):
                if isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual):
                    self.low = max(self.low, f.value + isinstance(f, GreaterThan))
                if isinstance(f, EqualTo | LessThan | LessThanOrEqual):
                    self.high = min(self.high, f.value - isinstance(f, LessThan))
            else:
                yield f
                continue
            if column == "channel":
                yield f  # a line may name another channel than its folder, so Spark looks again

    def partitions(self) -> list[Share]:
        out = []
        for channel, files in listing(self.folder).items():
            if self.low <= self.high and (self.channels is None or channel in self.channels):
                out += shares(files, [[self.low, self.high]])
        return tasks(out)


class ArchiveStream(_Reader, DataSourceStreamReader):
    """Offsets are the ranges of numbers that were read, by channel."""

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {channel: union([[first, last] for first, last, _, _ in files]) for channel, files in sorted(listing(self.folder).items())}

    def partitions(self, start: dict, end: dict) -> list[Share]:
        files, out = listing(self.folder), []
        for channel, ranges in end.items():
            out += shares(files.get(channel, []), minus(ranges, start.get(channel, [])))
        return tasks(out)


class ChannelArchive(DataSource):
    """The source by name; its one option is path."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return MESSAGE

    def reader(self, schema: StructType) -> ArchiveReader:
        return ArchiveReader(self.options["path"])

    def streamReader(self, schema: StructType) -> ArchiveStream:
        return ArchiveStream(self.options["path"])


def _registered(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(ChannelArchive)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Every message of an archive, each number of a channel once."""
    _registered(spark)
    return spark.read.format(NAME).load(folder)


def stream_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Messages as a stream: a batch has the numbers that no earlier batch of the checkpoint had."""
    _registered(spark)
    return spark.readStream.format(NAME).load(folder)


def export(messages: DataFrame, folder: str, numbers: int = 1000) -> None:
    """Adds messages to an archive, a file for each channel and so many numbers. Of messages that share channel and number one stays; rows without either, or with a number below 0, are left out.

    Rows are dealt by channel and block and sorted, so a task writes its files one after another and holds a batch of rows. A file is written beside its place and then moved, so a task that runs twice leaves it once."""
    spark = messages.sparkSession
    bounded_batches(spark)
    names = [c.split()[0] for c in MESSAGE.split(", ")]
    rows = keep_first(messages.select(*names).where("channel is not null and message_id >= 0"), ["channel", "message_id"], ["scraped_at", "posted_at", "text", "channel_title"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opened(folder)
        given = (row for batch in batches for row in batch.to_pylist())
        for (channel, _), group in groupby(given, lambda row: (row["channel"], row["_block"])):
            at = f"{root}/{quote(channel, safe='')}"
            store.create_dir(at, recursive=True)
            beside, said = f"{at}/_{uuid.uuid4().hex}", []
            with store.open_output_stream(beside) as out:
                for row in group:
                    said.append(row["message_id"])
                    out.write(json.dumps({n: row[n] for n in names}, ensure_ascii=False).encode() + b"\n")
            store.move(beside, f"{at}/{said[0]}-{said[-1]}.jsonl")
            yield pa.RecordBatch.from_pylist([{"n": len(said)}])

    # a fixed number of tasks: small rows make many files, so tasks must not be put together by bytes
    dealt = rows.withColumn("_block", F.floor(F.col("message_id") / numbers)).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "channel", "_block")
    dealt.sortWithinPartitions("channel", "_block", "message_id").mapInArrow(write, "n long").write.format("noop").mode("overwrite").save()
