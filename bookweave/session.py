"""Sessions, and getting this package to the executors."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import SparkSession


def session(name: str = "bookweave", **conf: str) -> SparkSession:
    """A session with the settings this engine is laid out for; a cluster's own settings win where they are given."""
    builder = SparkSession.builder.appName(name).config("spark.sql.adaptive.enabled", "true").config("spark.sql.session.timeZone", "UTC")
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once a session: they may have neither our path nor our disk."""
    sc = spark.sparkContext
    if getattr(sc, "_bookweave_shipped", False):
        return
    root = Path(__file__).resolve().parent
    # texts are large: smaller Arrow batches than Spark's default bound what a Python worker holds at a time
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    target = Path(tempfile.mkdtemp()) / "bookweave_package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._bookweave_shipped = True


def release() -> None:
    """Give memory back that a Python worker holds but does not use; workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


try:
    _libc = ctypes.CDLL("libc.so.6")
except OSError:  # another C library
    _libc = None
