"""Readers and writers."""

from __future__ import annotations

import tarfile
import uuid
from collections.abc import Iterator
from io import BytesIO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LINE_TYPES
from ..scratch import hadoop, remove


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """A CSV catalogue, plain or gzip by its extension: a header, one line per volume, all values strings, names in snake case.

    A gzip file can't be split; keep the catalogue as many files or plain when it is large.
    """
    d = spark.read.csv(path, header=True, inferSchema=False, multiLine=False, escape='"')
    return d.toDF(*(c.strip().lower().replace(" ", "_").replace("%", "percent") for c in d.columns))


def pages(spark: SparkSession, path: str) -> DataFrame:
    """barcode, text_by_page from {barcode}_ocr.jsonl[.gz] files, one JSON string per line; blank lines are skipped."""
    whole = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+?)_ocr\.jsonl", 1).alias("barcode"), F.filter(F.split("value", "\n"), lambda x: F.trim(x) != "").alias("l"))
    text = F.transform("l", lambda x: F.get(F.from_json(F.concat(F.lit("["), x, F.lit("]")), "array<string>"), F.lit(0)))
    return whole.select("barcode", text.alias("text_by_page"))


#: Which member names hold what (fixed values); the first that fits.
MEMBERS = ((".tif", "images"), (".jp2", "images"), (".html", "hocr"), (".txt", "text"), (".xml", "gxml"), (".md5", "md5"))
ARCHIVE = "barcode string, images array<binary>, hocr array<string>, text array<string>, gxml string, md5 array<struct<md5: string, filename: string>>"


def archives(spark: SparkSession, path: str) -> DataFrame:
    """Raw tar archives, members in archive order. ValueError where their numbers do not fit."""

    def opened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, content in zip(b.path, b.content, strict=True):
                found: dict[str, list[bytes]] = {k: [] for k in ("images", "hocr", "text", "gxml", "md5")}
                with tarfile.open(fileobj=BytesIO(bytes(content))) as tar:
                    for member in tar:
                        kind = next((k for ext, k in MEMBERS if ext in member.name), None)
                        if kind and member.isfile():
                            found[kind].append(tar.extractfile(member).read())
                n = len(found["images"])
                md5 = [dict(zip(("md5", "filename"), line.split("  ", 1), strict=True)) for f in found["md5"] for line in f.decode().splitlines() if "  " in line]
                if {len(found["hocr"]), len(found["text"])} != {n} or not found["gxml"] or len(md5) != 3 * n + 1:
                    raise ValueError(f"{name}: members do not fit together")
                yield pd.DataFrame({"barcode": [name.rpartition("/")[2].partition(".")[0]], "images": [found["images"]], "hocr": [[x.decode() for x in found["hocr"]]], "text": [[x.decode() for x in found["text"]]], "gxml": [found["gxml"][-1].decode()], "md5": [md5]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(opened, ARCHIVE)


RIGHTS = "records map<string, struct<`marc-xml`: string>>, items array<struct<htid: string, fromRecord: string, rightsCode: string, lastUpdate: string, enumcron: string, usRightsString: string>>"


def rights(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """barcode, htid, doc from pre-fetched rights documents, one JSON file per volume named by its barcode."""
    text = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.json", 1).alias("barcode"), F.from_json("value", RIGHTS).alias("doc"))
    return text.select("barcode", F.concat(F.lit(prefix + "."), F.lower("barcode")).alias("htid"), "doc")


def exclusions(spark: SparkSession, path: str) -> DataFrame:
    """The exclusion list: one barcode a line."""
    return spark.read.text(path).select(F.trim("value").alias("barcode")).filter("barcode <> ''").distinct()


POSTPROCESSED = "barcode string, text_by_page array<string>, stats map<string,int>"


def postprocessed(spark: SparkSession, path: str, page_count: DataFrame | None = None) -> DataFrame:
    """Stored post-processed books; rows with unknown line types, or another number of pages than page_count has, fail when they are read."""
    d = spark.read.schema(POSTPROCESSED).parquet(path)
    known = F.forall(F.map_keys("stats"), lambda k: k.isin(*LINE_TYPES))
    d = d.withColumn("stats", F.when(known, F.col("stats")).otherwise(F.raise_error(F.lit("unknown line type"))))
    if page_count is None:
        return d
    n = page_count.select("barcode", F.col("count_from_ocr").alias("_n"))
    fits = F.col("_n").isNull() | (F.col("_n") == F.size("text_by_page"))
    return d.join(n, "barcode", "left").withColumn("text_by_page", F.when(fits, F.col("text_by_page")).otherwise(F.raise_error(F.lit("another number of pages")))).drop("_n")


def exists(spark: SparkSession, path: str) -> bool:
    at, files = hadoop(spark, path)
    return files.exists(at)


def ready(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end: the marker that Spark's committer leaves."""
    return exists(spark, f"{path}/_SUCCESS")


# --- sinks ---


def replace(df: DataFrame, path: str) -> None:
    """Write a table in place of the one at path, which df may read: the new one is written beside it first, then takes its name.

    A run that fails while writing leaves the old table as it was. One that ends between the two renames leaves the old
    table beside its place, from where recover() brings it back.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    new = f"{path}{NEW}{uuid.uuid4().hex}"
    try:
        df.write.parquet(new)
    except Exception:
        remove(spark, new)
        raise
    at, files = hadoop(spark, path)
    other = lambda p: spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
    if files.exists(at) and not files.rename(at, other(path + OLD)):
        raise OSError(f"could not move {path}")
    if not files.rename(other(new), at):
        raise OSError(f"could not move {new} to {path}")
    files.delete(other(path + OLD), True)


NEW, OLD = ".new-", ".old"


def recover(spark: SparkSession, path: str) -> None:
    """Bring a table back whose replacement was cut off between its renames."""
    at, files = hadoop(spark, path)
    old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + OLD)
    if files.exists(old):
        if files.exists(at):
            files.delete(old, True)
        else:
            files.rename(old, at)


def write_records(df: DataFrame, path: str, *, with_text: bool = True, skip: int = 0) -> int:
    """Published records as train-00000-of-00010.parquet and so on, 100 rows a file with text, a million without.

    Spark writes the files beside their place; then those from number ``skip`` on are renamed into it, so that a run cut
    off there can be taken up. Returns the number of files.
    """
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}{NEW}{uuid.uuid4().hex}"
    try:
        df.write.option("maxRecordsPerFile", 100 if with_text else 1_000_000).parquet(staged)
        at, files = hadoop(spark, staged)
        target = hadoop(spark, path)[0]
        files.mkdirs(target)
        found = sorted(f.getPath().getName() for f in files.listStatus(at) if f.getPath().getName().startswith("part-"))
        kind = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for i, name in enumerate(found):
            if i >= skip:
                to = kind(target, f"train-{i:05}-of-{len(found):05}.parquet")
                files.delete(to, False)
                if not files.rename(kind(at, name), to):
                    raise OSError(f"could not move {name}")
    finally:
        remove(spark, staged)
    return len(found)


def write_sheet(df: DataFrame, path: str) -> None:
    """A small report as one CSV file with a header."""
    flat = [F.col(f"`{f.name}`") if not isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else F.to_json(f.name).alias(f.name) for f in df.schema]
    df.select(*flat).coalesce(1).write.mode("overwrite").csv(path, header=True)


def write_export(df: DataFrame, path: str) -> None:
    """A large table as CSV files with headers, in as many files as it has partitions."""
    df.write.mode("overwrite").csv(path, header=True, escape='"')


def write_training_sets(df: DataFrame, path: str) -> None:
    """text, target as CSV, a folder per set."""
    df.select("set", F.col("prompt").alias("text"), F.col("target_topic").alias("target")).write.mode("overwrite").partitionBy("set").csv(path, header=True, escape='"')


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)
