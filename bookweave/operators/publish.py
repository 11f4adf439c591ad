"""The published record: one wide nested row per book."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import HAS_TEXT_TOKENS, MIN_LANGUAGE_TOKENS
from . import language
from . import metadata as M

ANALYSIS = ("tokenizability", "char_count", *(f"{u}_{m}" for u in ("word", "bigram", "trigram") for m in ("count", "count_unique", "type_token_ratio")), "sentence_count", "sentence_count_unique")


def rows(t: dict[str, DataFrame], *, include_text: bool = True, include_rights: bool = True, pd_only: bool = True) -> DataFrame:
    """t: catalogue, pages (barcode, text_by_page_src, text_by_page_gen) and fact tables. All joins share one key."""
    d = t["catalogue"]
    if pd_only:
        d = d.join(t["is_pd"].filter("is_pd").select("barcode"), "barcode", "left_semi")
    d = d.join(t["token_count"].filter(F.col("count") > HAS_TEXT_TOKENS).select("barcode", F.col("count").alias("tokens")), "barcode")

    def analysis(name: str, as_: str) -> DataFrame:
        return t[name].select("barcode", F.when(F.col("tokenizability").isNotNull(), F.struct(*ANALYSIS)).alias(as_))

    for other in (
        t["page_count"].select("barcode", F.col("count_from_ocr").alias("page_count_src")),
        t["main_language"].select("barcode", F.col("from_metadata_iso639_3").alias("language_src"), F.col("from_detection_iso639_3").alias("language_gen")),
        language.distribution(t["language_detection"], MIN_LANGUAGE_TOKENS).withColumnRenamed("language_distribution", "language_distribution_gen"),
        t["topic_classification"].select("barcode", F.col("from_metadata").alias("topic_or_subject_src"), F.col("from_detection").alias("topic_or_subject_gen"), F.col("detection_confidence").alias("topic_or_subject_score_gen")),
        t["genre_classification"].select("barcode", F.col("from_metadata").alias("genre_or_form_src")),
        t["ocr_quality"].select("barcode", F.col("from_metadata").alias("ocr_score_src"), F.col("from_detection").alias("ocr_score_gen")),
        t["likely_duplicates"].select("barcode", F.col("likely_duplicates").alias("likely_duplicates_barcodes_gen")),
        analysis("text_analysis", "a_src"),
        analysis("ocr_postprocessing_text_analysis", "a_gen"),
        t["rights"].select("barcode", F.struct(F.concat(F.lit("https://hdl.handle.net/2027/"), "htid").alias("url"), "rights_code", "reason_code", F.date_format("retrieved_date", "yyyy-MM-dd").alias("last_check")).alias("rights_ext")),
        *([t["pages"]] if include_text else []),
    ):
        d = d.join(other, "barcode", "left")
    text = [F.col("text_by_page_src"), F.col("text_by_page_gen")] if include_text else []
    return d.select(
        F.col("barcode").alias("barcode_src"),
        M.clean_title("marc_title", "marc_title_remainder", drop="/").alias("title_src"),
        M.clean_title("marc_author_personal", drop=",").alias("author_src"),
        F.nullif(F.trim("marc_date_1"), F.lit("")).alias("date1_src"),
        F.nullif(F.trim("marc_date_2"), F.lit("")).alias("date2_src"),
        F.nullif(F.trim("marc_date_type"), F.lit("")).alias("date_types_src"),
        "page_count_src", F.col("tokens").alias("token_count_gen"), "language_src", "language_gen", "language_distribution_gen", "topic_or_subject_src", "topic_or_subject_gen", "topic_or_subject_score_gen", "genre_or_form_src",
        F.nullif(F.trim("marc_general_note"), F.lit("")).alias("general_note_src"), "ocr_score_src", "ocr_score_gen", "likely_duplicates_barcodes_gen",
        F.struct(F.col("a_src").alias("text_by_page_src"), F.col("a_gen").alias("text_by_page_gen")).alias("text_analysis_gen"),
        F.struct(*(M.identifiers(f"marc_{c}").alias(c) for c in ("lccn", "isbn", "ocolc"))).alias("identifiers_src"),
        *([F.col("rights_ext")] if include_rights else []), *text,
    )


def integrity(published: DataFrame, computed: DataFrame, key: str = "barcode_src") -> DataFrame:
    """One row per column that both have: how many records differ; and records that one side lacks."""
    columns = [c for c in published.columns if c != key and c in computed.columns]
    both = published.alias("p").withColumn("_p", F.lit(1)).join(computed.alias("c").withColumn("_c", F.lit(1)), key, "full")
    differs = [F.count_if(F.col("_p").isNotNull() & F.col("_c").isNotNull() & ~F.to_json(F.struct(F.col(f"p.{c}"))).eqNullSafe(F.to_json(F.struct(F.col(f"c.{c}"))))).alias(c) for c in columns]
    found = both.agg(*differs, F.count_if(F.col("_c").isNull()).alias("(only published)"), F.count_if(F.col("_p").isNull()).alias("(only computed)"))
    names = [*columns, "(only published)", "(only computed)"]
    return found.select(F.explode(F.array(*(F.struct(F.lit(n).alias("column"), F.col(f"`{n}`").alias("different")) for n in names))).alias("x")).select("x.*")


#: Columns of the simplified export, in order.
EXPORTED = (
    "Barcode", "Google Books Link", "Hathitrust Link", "MARC Control Number", "MARC Date 1", "MARC Date 2", "MARC Date Type", "MARC Language", "MARC LCCN", "MARC ISBN", "MARC OCLC Numbers", "MARC LC Call Number",
    "MARC Author Personal", "MARC Author Corporate", "MARC Author Meeting", "MARC Title", "MARC Title Remainder", "MARC General Note", "MARC Subjects", "MARC Genres",
    "Scanned Date", "Converted Date", "Downloaded Date", "Processed Date", "Analyzed Date", "OCR Date", "GRIN State", "GRIN Viewability", "GRIN Conditions", "GRIN Scannable", "GRIN Opted Out", "GRIN Tagging",
    "GRIN Audit", "GRIN Material Error %", "GRIN Overall Error %", "GRIN Claimed", "GRIN OCR Analysis Score", "GRIN OCR GTD Score", "GRIN Digitization Method",
)
LINK = "https://babel.hathitrust.org/cgi/pt?id="


def column_name(header: str) -> str:
    """A header of the catalogue as a column of it."""
    return header.strip().lower().replace(" ", "_").replace("%", "percent")


def simplified(catalogue: DataFrame, is_pd: DataFrame | None = None, *, prefix: str = "") -> DataFrame:
    """All EXPORTED columns under their headers; empty where the catalogue has no such column. Open-access books only, if is_pd is given."""
    d = catalogue if is_pd is None else catalogue.join(is_pd.filter("is_pd").select("barcode"), "barcode", "left_semi")
    link = F.concat(F.lit(f"{LINK}{prefix}."), F.lower("barcode")) if prefix else F.lit("")
    value = lambda h: link if h == "Hathitrust Link" else F.col(column_name(h)) if column_name(h) in d.columns else F.lit(None).cast("string")
    return d.select(*(value(h).alias(h) for h in EXPORTED))
