"""Makes this package importable by Python workers, wherever they run."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import SparkSession

_shipped: set[str] = set()
#: Rows and bytes of an Arrow batch: long texts and pages must not meet by the thousand in one Python worker.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def ship(spark: SparkSession) -> None:
    """Sends the package's sources to the executors, once an application; Spark's file server serves them."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    path = os.path.realpath(os.path.join(tempfile.mkdtemp(prefix="millrace-"), f"{root.name}.zip"))
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def give_back() -> None:
    """Returns what this Python worker has freed to the system. Workers are used again, and their allocators keep what earlier tasks freed, on top of which the next task's peak would come."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # where the C library has it
        trim(0)


def _lower(spark: SparkSession, name: str, most: int) -> None:
    given = spark.conf.get(name, None)
    try:
        if given is not None and 0 < int(given) <= most:
            return
    except ValueError:  # with a unit, as 64MB
        pass
    spark.conf.set(name, str(most))


def bounded_batches(spark: SparkSession) -> None:
    """Bounds what a Python worker holds at a time, and lets workers import this package. The bounds are read when a plan runs, so they stay set in the session; bounds that are smaller already are kept."""
    ship(spark)
    _lower(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    _lower(spark, "spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
