"""Catalogue columns to fact tables. One row per book each, nulls where the catalogue says nothing usable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BIBLIOGRAPHIC, PD_ACCESS, PD_CODES
from ..scratch import bounded


def known(c: str) -> Column:
    """The value as it stands if it is more than blanks."""
    return F.when(F.trim(c) != "", F.col(c))


def index(catalogue: DataFrame) -> DataFrame:
    parses = lambda c: F.try_to_timestamp(F.nullif(F.trim(c), F.lit(""))).isNotNull()
    return catalogue.select("barcode", parses("sync_timestamp").alias("archive_is_available"), parses("enrichment_timestamp").alias("metadata_is_enriched"))


def genre(catalogue: DataFrame) -> DataFrame:
    return catalogue.select("barcode", known("marc_genres").alias("from_metadata"), F.when(known("marc_genres").isNotNull(), "MARC Genres").alias("metadata_source"))


def topic(catalogue: DataFrame) -> DataFrame:
    return catalogue.select("barcode", known("marc_subjects").alias("from_metadata"), F.when(known("marc_subjects").isNotNull(), "MARC Subjects").alias("metadata_source"))


def iso639(spark: SparkSession, registry: str | None = None) -> DataFrame:
    """The language dimension: two letters, bibliographic and terminological code, English name.

    By default the languages with a two-letter code, as the JVM's locale data has them; or all of the standard's
    registry file (lines of code|terminological code|two letters|English name|French name).
    """
    schema = "pt1 string, pt2b string, pt3 string, name string"
    if registry is not None:
        part = lambda i: F.nullif(F.trim(F.get(F.split("value", r"\|"), F.lit(i))), F.lit(""))
        return spark.read.text(registry).select(part(2).alias("pt1"), F.translate(part(0), "\ufeff", "").alias("pt2b"), F.coalesce(part(1), F.translate(part(0), "\ufeff", "")).alias("pt3"), part(3).alias("name")).filter("pt2b rlike '^[a-z]{3}$'")
    locale = spark.sparkContext._jvm.java.util.Locale
    other = {t: b for b, t in BIBLIOGRAPHIC.items()}
    rows = [(code, other.get(own.getISO3Language(), own.getISO3Language()), own.getISO3Language(), own.getDisplayLanguage(locale.ENGLISH)) for code in locale.getISOLanguages() for own in [locale.forLanguageTag(code)]]
    return spark.createDataFrame(sorted({r[2]: r for r in rows if r[2]}.values()), schema)


def main_language(catalogue: DataFrame, languages: DataFrame, detected: DataFrame | None = None) -> DataFrame:
    """The catalogue's language and, given language.main()'s answer, the detected one. Unknown codes are null."""
    found = catalogue.join(bounded(languages), catalogue["marc_language"] == languages["pt2b"], "left")
    d = found.select("barcode", F.col("pt2b").alias("from_metadata_iso639_2b"), F.col("pt3").alias("from_metadata_iso639_3"), F.when(F.col("pt2b").isNotNull(), "MARC Language").alias("metadata_source"))
    if detected is None:
        none = F.lit(None).cast("string")
        return d.select("*", none.alias("from_detection_iso639_2b"), none.alias("from_detection_iso639_3"), none.alias("detection_source"))
    d = d.join(detected.select("barcode", "from_detection_iso639_2b", "from_detection_iso639_3"), "barcode", "left")
    return d.withColumn("detection_source", F.when(F.col("from_detection_iso639_3").isNotNull(), "detector"))


def ocr_quality(catalogue: DataFrame) -> DataFrame:
    """Integers as the catalogue writes them: blanks around, a sign, single underscores between digits."""
    c = F.trim("ocr_score")
    number = F.when(c.rlike(r"^[+-]?[0-9]+(_[0-9]+)*$"), F.expr("try_cast(replace(trim(ocr_score), '_', '') as int)"))
    return catalogue.select("barcode", number.alias("from_metadata"))


def year(catalogue: DataFrame) -> DataFrame:
    """The first date of four digits other than 9999, unless the date type says that there is no single date."""
    ok = lambda c: F.col(c).rlike("^[0-9]{4}$") & (F.col(c) != "9999")
    open_ended = F.coalesce(F.col("marc_date_type").startswith("Continuing resource") | F.col("marc_date_type").startswith("No attempt to code"), F.lit(False))
    text = F.when(~open_ended, F.coalesce(F.when(ok("marc_date_1"), F.col("marc_date_1")), F.when(ok("marc_date_2"), F.col("marc_date_2"))))
    source = F.when(~open_ended, F.when(ok("marc_date_1"), "MARC Date 1").when(ok("marc_date_2"), "MARC Date 2"))
    d = catalogue.select("barcode", text.cast("int").alias("year"), source.alias("source_field"))
    to = lambda n: (F.floor(F.col("year") / n) * n).cast("int")
    return d.select("barcode", "year", to(10).alias("decade"), to(100).alias("century"), "source_field")


def rights(catalogue_keys: DataFrame, records: DataFrame, *, retrieved: str | None = None) -> DataFrame:
    """records: barcode, htid, and a parsed rights document (struct ``doc`` of records and items). One row per book.

    The reason comes from the MARC record that the item names. ``retrieved``: when the documents were fetched; default now.
    """
    item = F.get(F.filter("doc.items", lambda i: F.lower(i["htid"]) == F.lower("htid")), F.lit(0))
    d = catalogue_keys.select("barcode").join(records.select("barcode", "htid", item.alias("i"), "doc"), "barcode", "left")
    d = d.withColumn("xml", F.try_element_at("doc.records", F.col("i.fromRecord"))["marc-xml"])
    part = lambda a, n: F.expr(f"try_cast(substring(i.lastUpdate, {a}, {n}) as int)")
    return d.select(
        "barcode", F.col("i.fromRecord").alias("from_record"), "htid", F.col("i.rightsCode").alias("rights_code"), reason_code(F.col("xml"), "htid").alias("reason_code"),
        part(1, 4).alias("last_update_year"), part(5, 2).alias("last_update_month"), part(7, 2).alias("last_update_day"), F.when(~F.lower("i.enumcron").isin("", "false"), F.col("i.enumcron")).alias("enumcron"), F.col("i.usRightsString").alias("us_rights_string"),
        F.when(F.col("htid").isNotNull(), F.lit(retrieved).cast("timestamp") if retrieved else F.current_timestamp()).alias("retrieved_date"),
    )


def reason_code(xml: Column, htid: str) -> Column:
    """Subfield q of the last 974 field of a MARC record whose subfield u is the volume."""
    part = lambda field, code: F.trim(F.regexp_extract(field, f'<subfield[^>]*code="{code}"[^>]*>([^<]*)<', 1))
    fields = F.filter(F.regexp_extract_all(xml, F.lit(r'(?s)<datafield[^>]*tag="974".*?</datafield>'), F.lit(0)), lambda f: part(f, "u") == F.col(htid))
    return F.nullif(part(F.get(fields, F.size(fields) - 1), "q"), F.lit(""))


def is_pd(books: DataFrame, mode: str, *, rights: DataFrame | None = None, excluded: DataFrame | None = None) -> DataFrame:
    """barcode, is_pd. Mode "rights": code and access say so (no row: not open). Mode "list": not on the exclusion list."""
    if mode == "rights":
        open_ = F.coalesce(F.col("rights_code").isin(*PD_CODES) & (F.col("us_rights_string") == PD_ACCESS), F.lit(False))
        return books.select("barcode").join(rights.select("barcode", "rights_code", "us_rights_string"), "barcode", "left").select("barcode", open_.alias("is_pd"))
    if mode == "list":
        listed = excluded.select("barcode").distinct().withColumn("_out", F.lit(True))
        return books.select("barcode").join(listed, "barcode", "left").select("barcode", F.col("_out").isNull().alias("is_pd"))
    raise ValueError(f"no such mode: {mode}")


def clean_title(*parts: str, drop: str) -> Column:
    """Trimmed parts joined by a space, without one trailing mark."""
    joined = F.trim(F.array_join(F.array(*(F.trim(F.coalesce(p, F.lit(""))) for p in parts)), " "))
    return F.trim(F.when(joined.endswith(drop), F.substring(joined, F.lit(1), F.length(joined) - len(drop))).otherwise(joined))


def identifiers(c: str) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def prompt(catalogue: DataFrame, languages: DataFrame, *, skip_topic: bool = False, skip_genre: bool = False) -> DataFrame:
    """A book's metadata as lines of text for a model; null where nothing is known."""
    line = lambda label, value, end="\n": F.when(F.coalesce(F.trim(value), F.lit("")) != "", F.concat(F.lit(label), value, F.lit(end)))
    spaced = lambda *c: F.concat(*(F.when(F.trim(F.coalesce(x, F.lit(""))) != "", F.concat(F.col(x), F.lit(" "))).otherwise("") for x in c))
    d = catalogue.join(bounded(languages.select(F.col("pt2b").alias("marc_language"), "name")), "marc_language", "left")
    parts = [line("Title: ", spaced("marc_title", "marc_title_remainder")), line("Author: ", spaced("marc_author_personal")), line("Year: ", F.col("marc_date_1")), line("Language: ", F.col("name"))]
    parts += [] if skip_topic else [line("Subject/Topic: ", F.col("marc_subjects"))]
    parts += [] if skip_genre else [line("Genre/Form: ", F.col("marc_genres"))]
    parts += [line("General note: ", F.col("marc_general_note"), "")]
    return d.select("barcode", F.nullif(F.concat_ws("", *parts), F.lit("")).alias("prompt"))
