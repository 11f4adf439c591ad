"""Tables in the folder that the driver and all executors share: they cut lineage and survive lost executors."""

from __future__ import annotations

import atexit
import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import ship


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir. A local master, whose driver and executors are one process, may do without; a cluster may not."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return "/tmp/bookweave-checkpoints"


def remove(spark: SparkSession, path: str) -> None:
    at, files = hadoop(spark, path)
    files.delete(at, True)


def hadoop(spark: SparkSession, path: str):
    """A path and its file system."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def bounded(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """Broadcast a table that is counted as small enough; larger ones are joined by shuffling."""
    return F.broadcast(df) if df.count() <= rows else df


class Scratch:
    """Tables written to the shared folder and read back as Parquet.

    What a returned, still lazy DataFrame reads has to stay until the session ends; everything else is dropped
    with ``drop`` as soon as the next table has been written.
    """

    def __init__(self, spark: SparkSession, what: str):
        ship(spark)
        self.spark, self.root = spark, f"{shared_folder(spark)}/bookweave/{what}-{uuid.uuid4().hex}"
        self._n = 0
        _open.append((spark, self.root))

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df: DataFrame) -> None:
        """Delete the files behind a table that write() returned; tables of others are left alone."""
        for root in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if f"/{self.root.rpartition('/')[2]}/" in f"{root}/":
                remove(self.spark, root)

    def clear(self) -> None:
        """Delete all tables written so far."""
        remove(self.spark, self.root)

    def tidy(self) -> None:
        """Have the shuffle files of finished jobs deleted now; they stay until the driver happens to collect its garbage."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


_open: list[tuple[SparkSession, str]] = []


@atexit.register
def _clean() -> None:
    for spark, root in _open:
        try:
            remove(spark, root)
        except Exception:  # noqa: BLE001 - the session may be gone already
            continue
