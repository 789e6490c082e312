"""The folder that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_used: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """What the cluster names in spark.checkpoint.dir; a local folder only where it is unset and executors are local too, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext._jsc.sc()
    if not context.getCheckpointDir().isDefined():
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return context.getCheckpointDir().get().rstrip("/")


def _own(spark: SparkSession) -> str:
    """What this application has in it."""
    return f"{shared_folder(spark)}/millrace/{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in it that nobody else has. It goes with clear(), at the latest when the driver's Python ends."""
    own = _own(spark)
    if own not in _used:
        _used.add(own)
        atexit.register(_remove, spark._jvm, spark._jsc.hadoopConfiguration(), own)
    return f"{own}/{uuid.uuid4().hex}/{name}"


def lasting_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody else has, for results: it stays when the application ends."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _remove(jvm, conf, path: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone by now
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)


def clear(spark: SparkSession) -> None:
    """Deletes every intermediate table of this application. Results that weren't written elsewhere can't be read after."""
    _remove(spark._jvm, spark._jsc.hadoopConfiguration(), _own(spark))


def discard(df: DataFrame) -> None:
    """Deletes a table that materialised() wrote, once nothing reads it any more."""
    spark = df.sparkSession
    for f in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/millrace/" in f:
            _remove(spark._jvm, spark._jsc.hadoopConfiguration(), f)


def materialised(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, reread: computed once however often it is used, and safe from lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
