"""Languages of a book's text, from chunks; and OCR quality as far as languages can tell."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..scratch import bounded

#: Frequent words per language (fixed values); the default detector counts them.
FREQUENT = {
    "eng": "the and of to in is that for with was are this by from have not",
    "fra": "le la les des et une dans qui que pour est sur avec pas du au",
    "deu": "der die und das den von mit ist nicht ein eine dem des auf für als",
    "spa": "el los las una que con por para del como más su es en se al",
}


def detect(chunk: Column, detector: Callable[[pd.Series], pd.Series] | None = None) -> Column:
    """ISO 639-3 code of a chunk or "und". The default counts frequent words; ties go to the first language by code."""
    if detector is not None:
        return F.pandas_udf(detector, "string")(chunk)
    words = F.split(F.lower(chunk), r"[^\p{L}]+")
    among = lambda own: F.size(F.filter(words, lambda w: w.isin(*own.split())))
    hits = [F.struct(among(own).alias("n"), F.lit(-i).alias("tie"), F.lit(code).alias("code")) for i, (code, own) in enumerate(sorted(FREQUENT.items()))]
    best = F.greatest(*hits)
    return F.when(best["n"] > 0, best["code"]).otherwise("und")


def detections(books: DataFrame, languages: DataFrame, *, size: int = 768, detector=None) -> DataFrame:
    """One row per book and language: tokens and percentage of the book's tokens."""
    c = T.chunks(books, size).withColumn("iso639_3", detect(F.col("chunk"), detector))
    c = c.withColumn("n", F.aggregate(T.words(F.col("chunk")), F.lit(0).cast("long"), lambda a, x: a + T.token_count(x)))
    by = c.groupBy("barcode", "iso639_3").agg(F.sum("n").alias("token_count"))
    return shares(by).join(bounded(languages.select(F.col("pt3").alias("iso639_3"), F.col("pt2b").alias("iso639_2b"))), "iso639_3", "left")


def shares(by: DataFrame) -> DataFrame:
    return by.withColumn("percentage_of_total", F.try_divide("token_count", F.sum("token_count").over(Window.partitionBy("barcode"))) * 100)


def main(detected: DataFrame) -> DataFrame:
    """The language with most tokens, unless that is undetermined."""
    top = detected.groupBy("barcode").agg(F.max_by(F.struct("iso639_3", "iso639_2b"), F.struct("token_count", "iso639_3")).alias("l"))
    known = F.col("l.iso639_3") != "und"
    return top.select("barcode", F.when(known, F.col("l.iso639_2b")).alias("from_detection_iso639_2b"), F.when(known, F.col("l.iso639_3")).alias("from_detection_iso639_3"))


def distribution(detected: DataFrame, least: int) -> DataFrame:
    """barcode, language_distribution: (language, proportion), most tokens first, of those with ``least`` tokens."""
    kept = detected.filter((F.col("token_count") >= least) & (F.coalesce("iso639_3", F.lit("")) != "") & (F.col("percentage_of_total") > 0))
    rows = F.sort_array(F.collect_list(F.struct((-F.col("token_count")).alias("n"), F.col("iso639_3").alias("language"), F.col("percentage_of_total").alias("proportion"))))
    return kept.groupBy("barcode").agg(F.transform(rows, lambda x: F.struct(x["language"].alias("language"), x["proportion"].alias("proportion"))).alias("language_distribution"))


def ocr_quality(books: DataFrame, size: int = 120) -> DataFrame:
    """0..100: share of a text's segments whose language can be told, cut to an integer; blank text has no row."""
    c = T.chunks(books, size, least=1).withColumn("ok", (detect(F.col("chunk")) != "und").cast("int"))
    return c.groupBy("barcode").agg(F.floor(F.avg("ok") * 100).cast("int").alias("from_detection"))
