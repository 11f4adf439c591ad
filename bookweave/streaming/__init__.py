"""Streaming ingestion: new page files become fact rows as they arrive. The batch operators are the same functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..scratch import remove
from ..sources import replace


def page_stream(spark: SparkSession, path: str) -> DataFrame:
    """barcode, text, arrived as JSON lines files {barcode, text} are added to a folder."""
    pages = spark.readStream.schema("barcode string, text string").json(path)
    return pages.select("barcode", "text", F.col("_metadata.file_modification_time").alias("arrived"))


def maintain(stream: DataFrame, compute: Callable[[DataFrame], DataFrame], table_path: str, checkpoint: str) -> StreamingQuery:
    """Keep a fact table up to date: each micro-batch adds the rows of its books as a folder of its own.

    A batch costs what it holds, not what the table holds; a batch that is repeated after a failure replaces its folder.
    Of a book that a batch holds twice, the text that arrived last counts (at one moment: the longest).
    """

    def add(batch: DataFrame, number: int) -> None:
        newest = F.struct(*(["arrived"] if "arrived" in batch.columns else []), F.length("text"))
        last = batch.groupBy("barcode").agg(F.max_by("text", newest).alias("text"))
        compute(last).write.mode("overwrite").parquet(f"{table_path}/batch={number}")

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, table_path: str, schema: str) -> DataFrame:
    """The table as it stands: of every book, all rows of the last batch that has any."""
    rows = spark.read.schema(f"{schema}, batch long").parquet(table_path)
    last = rows.groupBy("barcode").agg(F.max("batch").alias("batch"))
    return rows.join(last, ["barcode", "batch"], "left_semi").drop("batch")


def compact(spark: SparkSession, table_path: str, schema: str) -> None:
    """Put all batches so far into one, between two runs of the stream."""
    batches = sorted(int(r[0]) for r in spark.read.schema(f"{schema}, batch long").parquet(table_path).select("batch").distinct().collect())
    if len(batches) > 1:
        replace(current(spark, table_path, schema), f"{table_path}/batch={batches[-1]}")
        for n in batches[:-1]:
            remove(spark, f"{table_path}/batch={n}")


def windowed_counts(events: DataFrame, *, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Events per window and type, late data bounded by a watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").count()
