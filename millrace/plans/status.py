"""What has become of each post: a log of status changes, of which the latest holds, committed run by run.

A run's changes are written to a folder of their own, which nobody reads until a commit names it. Commits are numbered
files that come into being by a rename that fails if the number is taken, so a run is visible whole or not at all, and of
two runs at once the second finds its number taken and decides again on what the first has left. A run that is
repeated under its name adds nothing and gives what it gave before. Ids that have no change are parsed. The file system
must refuse to rename onto an existing file, as HDFS and local ones do. The driver reads one short line a run.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import STATES
from .envelope import outbox

_CHANGE = "id string, state string, version long"


@dataclass(frozen=True)
class Commit:
    version: int
    run: str
    folder: str


@dataclass(frozen=True)
class StatusLog:
    """In a folder that driver and executors share; it need not be there yet."""

    spark: SparkSession
    path: str

    def _hadoop(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def commits(self) -> list[Commit]:
        """Those that there are, in order."""
        where, fs = self._hadoop(f"{self.path}/commits")
        if not fs.exists(where):
            return []
        lines = self.spark.read.schema("version long, run string, folder string").json(f"{self.path}/commits")
        return sorted((Commit(*r) for r in lines.collect()), key=lambda c: c.version)

    def _commit(self, new: Commit) -> bool:
        """Whether it came into being; not if its number is taken."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        draft, fs = self._hadoop(f"{self.path}/drafts/{uuid.uuid4().hex}")
        out = fs.create(draft)
        out.write(bytearray(json.dumps(new.__dict__).encode()))
        out.close()
        final, _ = self._hadoop(f"{self.path}/commits/{new.version:012}.json")
        fs.mkdirs(final.getParent())
        kept = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)  # none: never over another file
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), conf).rename(draft, final, kept)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in str(e.java_exception.getClass().getName()):
                raise
            fs.delete(draft, False)
            return False
        return True

    def _changes(self, commits: list[Commit]) -> DataFrame:
        if not commits:
            return self.spark.createDataFrame([], _CHANGE)
        return self.spark.read.schema(_CHANGE).parquet(*(c.folder for c in commits))

    def latest(self, commits: list[Commit] | None = None) -> DataFrame:
        """id, state, version: of each id the last change; of changes that one run made to an id, the one furthest on."""
        changes = self._changes(self.commits() if commits is None else commits)
        order = F.struct("version", F.array_position(F.array(*map(F.lit, STATES)), F.col("state")))
        return changes.groupBy("id").agg(F.max_by("state", order).alias("state"), F.max("version").alias("version"))

    def append(self, decide: Callable[[DataFrame], DataFrame], run: str) -> DataFrame:
        """The changes (id, state) that the run makes: decide gets the latest statuses, and is asked again if another run was committed meanwhile. A state that isn't known fails the run."""
        while True:
            done = self.commits()
            own = [c for c in done if c.run == run]
            if own:
                return self._changes(own)
            version, folder = (done[-1].version if done else 0) + 1, f"{self.path}/changes/{uuid.uuid4().hex}"
            state = F.when(F.col("state").isin(*STATES), F.col("state")).otherwise(F.raise_error(F.concat(F.lit("no state: "), F.coalesce("state", F.lit("null")))))
            changes = decide(self.latest(done)).select("id", state.alias("state"), F.lit(version).cast("long").alias("version"))
            changes.write.parquet(folder)
            new = Commit(version, run, folder)
            if self._commit(new):
                return self._changes([new])
            where, fs = self._hadoop(folder)
            fs.delete(where, True)


def send(posts: DataFrame, log: StatusLog, task: str, threshold: float, run: str) -> DataFrame:
    """The posts that this run sends, marked as sent: those at or above the threshold that are neither sent nor irrelevant. The same run again gives the same posts, so a delivery that broke off can be repeated; another run gives none of them."""

    def due(latest: DataFrame) -> DataFrame:
        over = latest.where(F.col("state").isin("sent", "irrelevant"))
        return outbox(posts, over, task, threshold).select("id").distinct().withColumn("state", F.lit("sent"))

    return posts.join(log.append(due, run).select("id"), "id", "left_semi")
