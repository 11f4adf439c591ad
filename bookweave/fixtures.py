"""The book model over the driver's tables: what ``documents`` and ``labels`` lack is made up from doc_id, the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .operators import metadata as M
from .scratch import Scratch
from .session import ship

SUBJECTS = ("Philosophy", "Theology", "Biography", "World history", "Geography", "Statistics", "Law", "Education", "Music", "Literature", "Science", "Medicine", "Agriculture", "Philosophy, Law", "Unlisted subject")
LINES_PER_PAGE = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """A fact table: written once, so that what costs much is worked out once whatever reads it."""
    return Scratch(spark, "facts").write(df, name)


def barcode(c="doc_id"):
    return F.concat(F.lit("B"), F.lpad(F.col(c).cast("string"), 8, "0"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    cores = spark.sparkContext.defaultParallelism
    return d if len(d.inputFiles()) >= cores else d.repartition(2 * cores)


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """barcode, text."""
    return documents(spark, sf_dir).select(barcode().alias("barcode"), "text")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """barcode, text_by_page: five lines a page."""
    lines = F.split("text", "\n")
    count = F.ceil(F.size(lines) / LINES_PER_PAGE).cast("int")
    page = F.transform(F.sequence(F.lit(0), count - 1), lambda p: F.array_join(F.slice(lines, p * LINES_PER_PAGE + 1, LINES_PER_PAGE), "\n"))
    return documents(spark, sf_dir).select(barcode().alias("barcode"), page.alias("text_by_page"))


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the columns that a query uses are read; the text is not among them."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("_id"), "quality", "toxic")
    i = F.col("doc_id")
    d = d.join(labels, i == F.col("_id"), "left")
    text = lambda c: c.cast("string")
    return d.select(
        "doc_id",
        barcode().alias("barcode"),
        F.lit("2024-01-02 03:04:05").alias("sync_timestamp"),
        F.when(i % 3 != 0, "2024-02-03 00:00:00").otherwise("").alias("enrichment_timestamp"),
        F.when(i % 13 == 0, "9999").when(i % 11 == 0, "19uu").otherwise(text(1700 + i % 320)).alias("marc_date_1"),
        F.when(i % 2 == 0, "").otherwise(text(1900 + i % 100)).alias("marc_date_2"),
        F.when(i % 19 == 0, "Continuing resource currently published").otherwise("Single known date").alias("marc_date_type"),
        F.when(i % 17 != 0, F.expr("case lang when 'en' then 'eng' when 'fr' then 'fre' when 'de' then 'ger' when 'es' then 'spa' end")).alias("marc_language"),
        F.when(i % 5 == 0, " ").otherwise(F.element_at(F.array(*map(F.lit, SUBJECTS)), (i % len(SUBJECTS) + 1).cast("int"))).alias("marc_subjects"),
        F.when(i % 7 == 0, "").otherwise(F.concat(F.lit("Genre "), text(i % 60))).alias("marc_genres"),
        F.when(F.col("quality").isNull(), "").otherwise(F.concat(F.lit(" "), text(F.col("quality") * 60 + i % 40), F.lit(" "))).alias("ocr_score"),
        F.concat(F.lit(" Title "), text(i), F.lit(" /")).alias("marc_title"),
        F.when(i % 4 == 0, F.lit(None).cast("string")).otherwise("a remainder / ").alias("marc_title_remainder"),
        F.concat(F.lit("Author "), text(i % 50), F.lit(", ")).alias("marc_author_personal"),
        F.when(i % 6 == 0, "A note").otherwise(" ").alias("marc_general_note"),
        F.concat(F.lit(" a"), text(i), F.lit(", ,b"), text(i % 9), F.lit(" ")).alias("marc_lccn"),
        F.when(i % 2 == 0, "").otherwise(F.concat(F.lit("978"), text(i))).alias("marc_isbn"),
        F.concat(text(i), F.lit(","), text(i + 1)).alias("marc_ocolc"),
        F.when(F.col("toxic") == 0, "pd").when(F.col("toxic") == 1, "ic").alias("rights_code"),
        F.when(F.col("toxic") == 0, "Full view").when(F.col("toxic") == 1, "Limited (search-only)").alias("us_rights_string"),
        F.when(F.col("toxic").isNotNull(), F.when(i % 2 == 0, "bib").otherwise("ren")).alias("reason_code"),
        F.when(F.col("toxic").isNotNull(), F.concat(F.lit("lib.b"), F.lpad(text(i), 8, "0"))).alias("htid"),
        F.when(F.col("toxic").isNotNull(), F.lit("2024-03-04 05:06:07").cast("timestamp")).alias("retrieved_date"),
    )


def languages(spark: SparkSession) -> DataFrame:
    return M.iso639(spark)


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.tokens(books(spark, sf_dir))


#: The same in DuckDB: views that the queries' SQL starts from.
SQL = f"""
WITH cat AS (
  SELECT d.doc_id, 'B' || lpad(d.doc_id::VARCHAR, 8, '0') AS barcode, d.text, d.lang,
    CASE WHEN d.doc_id % 3 <> 0 THEN '2024-02-03 00:00:00' ELSE '' END AS enrichment_timestamp,
    CASE WHEN d.doc_id % 13 = 0 THEN '9999' WHEN d.doc_id % 11 = 0 THEN '19uu' ELSE (1700 + d.doc_id % 320)::VARCHAR END AS marc_date_1,
    CASE WHEN d.doc_id % 2 = 0 THEN '' ELSE (1900 + d.doc_id % 100)::VARCHAR END AS marc_date_2,
    CASE WHEN d.doc_id % 19 = 0 THEN 'Continuing resource currently published' ELSE 'Single known date' END AS marc_date_type,
    CASE WHEN d.doc_id % 17 <> 0 THEN CASE lang WHEN 'en' THEN 'eng' WHEN 'fr' THEN 'fre' WHEN 'de' THEN 'ger' WHEN 'es' THEN 'spa' END END AS pt2b,
    CASE WHEN d.doc_id % 17 <> 0 THEN CASE lang WHEN 'en' THEN 'eng' WHEN 'fr' THEN 'fra' WHEN 'de' THEN 'deu' WHEN 'es' THEN 'spa' END END AS pt3,
    CASE WHEN d.doc_id % 17 <> 0 THEN CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' WHEN 'de' THEN 'German' WHEN 'es' THEN 'Spanish' END END AS language_name,
    CASE WHEN d.doc_id % 5 <> 0 THEN ({list(SUBJECTS)})[(d.doc_id % {len(SUBJECTS)} + 1)::INT] END AS topic,
    CASE WHEN d.doc_id % 7 <> 0 THEN 'Genre ' || (d.doc_id % 60) END AS genre,
    (quality * 60 + d.doc_id % 40)::INT AS ocr_score,
    CASE toxic WHEN 0 THEN 'pd' WHEN 1 THEN 'ic' END AS rights_code,
    CASE WHEN toxic = 0 THEN 'Full view' WHEN toxic = 1 THEN 'Limited (search-only)' END AS us_rights_string,
    CASE WHEN toxic IS NOT NULL THEN CASE WHEN d.doc_id % 2 = 0 THEN 'bib' ELSE 'ren' END END AS reason_code,
    toxic IS NOT NULL AS has_rights, coalesce(toxic = 0, false) AS is_pd
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
yr AS (
  SELECT barcode, CASE WHEN marc_date_type NOT LIKE 'Continuing resource%' THEN
      CASE WHEN regexp_full_match(marc_date_1, '[0-9]{{4}}') AND marc_date_1 <> '9999' THEN marc_date_1::INT
           WHEN regexp_full_match(marc_date_2, '[0-9]{{4}}') AND marc_date_2 <> '9999' THEN marc_date_2::INT END END AS year,
    CASE WHEN marc_date_type NOT LIKE 'Continuing resource%' THEN
      CASE WHEN regexp_full_match(marc_date_1, '[0-9]{{4}}') AND marc_date_1 <> '9999' THEN 'MARC Date 1'
           WHEN regexp_full_match(marc_date_2, '[0-9]{{4}}') AND marc_date_2 <> '9999' THEN 'MARC Date 2' END END AS source_field FROM cat),
y AS (SELECT *, (year // 10 * 10)::INT AS decade, (year // 100 * 100)::INT AS century FROM yr),
f AS (SELECT barcode, doc_id, lang, text, replace(replace(lower(text), chr(10), ''), chr(8203), '') AS t FROM cat),
w AS (SELECT *, regexp_extract_all(t, '[\\p{{L}}\\p{{N}}_]+|[^\\s\\p{{L}}\\p{{N}}_]') AS ws,
    list_filter(string_split(regexp_replace(t, '([.!?]+)\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda s: trim(s) <> '') AS ss FROM f),
g AS (SELECT *, [ws[i] || ' ' || ws[i + 1] for i in range(1, len(ws))] AS w2, [ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] for i in range(1, len(ws) - 1)] AS w3 FROM w),
tok AS (SELECT barcode, coalesce(list_sum([ceil(length(x) / 4.0)::BIGINT for x in regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+|[^\\s\\p{{L}}\\p{{N}}_]')]), 0)::BIGINT AS n FROM cat),
ta AS (SELECT barcode, lang, length(text)::BIGINT AS char_count, length(translate(text, ' ' || chr(10) || chr(9) || chr(8203) || '-—', ''))::BIGINT AS char_count_continuous,
    len(ws)::BIGINT AS word_count, len(list_distinct(ws))::BIGINT AS word_count_unique, nullif(len(w2), 0)::BIGINT AS bigram_count, nullif(len(list_distinct(w2)), 0)::BIGINT AS bigram_count_unique,
    nullif(len(w3), 0)::BIGINT AS trigram_count, nullif(len(list_distinct(w3)), 0)::BIGINT AS trigram_count_unique, len(ss)::BIGINT AS sentence_count, len(list_distinct(ss))::BIGINT AS sentence_count_unique,
    list_sum([length(s) for s in ss]) / len(ss) AS average_sentence_length,
    least(100.0, len(ws) * 1.25 / list_sum([ceil(length(x) / 4.0)::BIGINT for x in ws]) * 100) AS tokenizability FROM g)
"""
