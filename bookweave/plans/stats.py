"""Collection statistics: tidy frames (section, caption, value, extra), one aggregate per question, never one per bucket."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import grouped
from ..schemas import HAS_TEXT_TOKENS, LINE_TYPES, PD_ACCESS, PD_CODES, TARGET_LLM


def edges(low: int, high: int, bins: int = 16) -> list[int]:
    """0, then log-spaced edges rounded half to even to one significant digit; small collections repeat some."""
    out = [0]
    for k in range(bins):
        x = 10 ** (math.log10(low) + (math.log10(high) - math.log10(low)) * k / (bins - 1))
        unit = 10 ** math.floor(math.log10(x))
        out.append(int(round(x / unit) * unit))
    return out


def histogram(values: DataFrame, c: str, low: int) -> DataFrame:
    """start, end, n of half-open bins, empty ones included; the maximum may fall outside, as rounding has it.

    One pass for the maximum, one that counts all bins.
    """
    high = values.agg(F.max(c)).first()[0] or low
    e = edges(low, max(high, low))
    pairs = list(zip(e, e[1:], strict=False))
    counts = values.agg(*(F.count_if((F.col(c) >= a) & (F.col(c) < b)).alias(f"n{i}") for i, (a, b) in enumerate(pairs)))
    rows = F.array(*(F.struct(F.lit(i).alias("bin"), F.lit(a).cast("long").alias("start"), F.lit(b).cast("long").alias("end"), F.col(f"n{i}").alias("n")) for i, (a, b) in enumerate(pairs)))
    return counts.select(F.explode(rows).alias("x")).select("x.*")


def captioned(df: DataFrame, **columns: Column) -> DataFrame:
    """One row of aggregates as (caption, value) rows."""
    agg = df.agg(*(c.cast("double").alias(k) for k, c in columns.items()))
    return agg.select(F.explode(F.array(*(F.struct(F.lit(k).alias("caption"), F.col(k).alias("value")) for k in columns))).alias("x")).select("x.*")


def count_by(df: DataFrame, c: str) -> DataFrame:
    return df.groupBy(F.col(c).alias("caption")).agg(F.count("*").alias("value"))


def top(df: DataFrame, c: str, n: int = 50) -> DataFrame:
    return count_by(df.filter(F.col(c).isNotNull()), c).orderBy(F.desc("value"), "caption").limit(n)


def books(t: DataFrame) -> DataFrame:
    """t: a row per book with pages and tokens."""
    return captioned(t, total=F.count("*"), with_scans=F.count_if(F.col("pages") > 0), with_text=F.count_if(F.col("tokens") > HAS_TEXT_TOKENS))


def rights(t: DataFrame) -> DataFrame:
    """t: a row per book with htid, rights_code, us_rights_string, pages, tokens."""
    pd = F.coalesce(F.col("rights_code").isin(*PD_CODES) & (F.col("us_rights_string") == PD_ACCESS), F.lit(False))
    return captioned(
        t, matched=F.count("htid"), without_code=F.count_if(F.col("rights_code").isNull()), open_access=F.count_if(pd), open_with_scans=F.count_if(pd & (F.col("pages") > 0)), open_with_text=F.count_if(pd & (F.col("tokens") > HAS_TEXT_TOKENS))
    )


def years(t: DataFrame) -> DataFrame:
    """Known: before 2025. Unknown: null only; later years are neither."""
    return captioned(t, known=F.count_if(F.col("year") < 2025), unknown=F.count_if(F.col("year").isNull()))


def by_century(t: DataFrame) -> DataFrame:
    return count_by(t.filter((F.col("year") < 2030) & (F.col("century") != 0) & (F.col("century") <= 2000)), "century")


def by_decade(t: DataFrame) -> DataFrame:
    return count_by(t.filter((F.col("decade") != 0) & (F.col("decade") <= 2020)), "decade")


def quality_by_decade(years: DataFrame, quality: DataFrame) -> DataFrame:
    """Decades come from the year table; a decade without scores has nulls. One grouped join, not a query per decade."""
    d = years.filter((F.col("decade") != 0) & (F.col("decade") <= 2020)).select("barcode", "decade").join(quality, "barcode", "left")
    return d.groupBy("decade").agg(F.avg("from_metadata").alias("mean_metadata"), F.avg("from_detection").alias("mean_detection"))


def dedup(hashes: DataFrame, groups: DataFrame) -> DataFrame:
    """Books with a fingerprint, different ones, members and number of groups, and what is left of the texts."""
    h = hashes.agg(F.count("hash").alias("with_hash"), F.countDistinct("hash").alias("unique_hashes"))
    g = groups.agg(F.count("*").alias("members"), F.countDistinct("hash").alias("groups"))
    return h.crossJoin(g).withColumn("unique_texts", F.col("with_hash") - F.col("members") + F.col("groups"))  # one row each


COMPARED = ("tokenizability", "word_count", "bigram_count", "trigram_count", "sentence_count")


def compared(src: DataFrame, gen: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """Means of source and processed text metrics by language or decade. groups: barcode and key."""
    pick = lambda t, s: t.select("barcode", *(F.col(c).alias(f"{c}_{s}") for c in COMPARED))
    d = groups.filter(F.col(key).isNotNull()).join(pick(src, "src"), "barcode").join(pick(gen, "gen"), "barcode")
    return d.groupBy(key).agg(*(F.avg(f"{c}_{s}").alias(f"{c}_{s}") for c in COMPARED for s in ("src", "gen")))


def line_types(processed: DataFrame) -> DataFrame:
    """Lines by type over all books' statistics."""
    return processed.select(F.explode("stats").alias("caption", "n")).groupBy("caption").agg(F.sum("n").cast("long").alias("value"))


def set_counts(lines: DataFrame, types: tuple[str, ...], sets: tuple[str, ...] = ("train", "test")) -> DataFrame:
    """Counts for every type and set, zeros included: types x sets conditional counts in one pass."""
    counts = lines.agg(*(F.count_if((F.col("target_type") == t) & (F.col("set") == s)).alias(f"{t}/{s}") for t in types for s in sets))
    rows = F.array(*(F.struct(F.lit(t).alias("target_type"), F.lit(s).alias("set"), F.col(f"`{t}/{s}`").alias("n")) for t in types for s in sets))
    return counts.select(F.explode(rows).alias("x")).select("x.*")


MEANS = ("char_count", "char_count_continuous", *(f"{u}_{m}" for u in ("word", "bigram", "trigram") for m in ("count", "count_unique", "type_token_ratio")), "sentence_count", "sentence_count_unique", "tokenizability")


def by(df: DataFrame, key: str, **measures: Column) -> DataFrame:
    """Grouped measures as (caption, value) rows: "key: measure"."""
    agg = df.groupBy(F.col(key).cast("string").alias("_k")).agg(*(c.cast("double").alias(k) for k, c in measures.items()))
    rows = F.array(*(F.struct(F.concat("_k", F.lit(f": {k}")).alias("caption"), F.col(k).alias("value"), F.col("_k").alias("extra")) for k in measures))
    return agg.select(F.explode(rows).alias("x")).select("x.*")


def bins(values: DataFrame, c: str, low: int) -> DataFrame:
    """A histogram with its bins as captions."""
    return histogram(values, c, low).select(F.concat(grouped(F.col("start")), F.lit(" - "), grouped(F.col("end"))).alias("caption"), F.col("n").alias("value"), F.col("bin").alias("extra"))


def with_value(df: DataFrame, c: str, **more: Column) -> DataFrame:
    return captioned(df, with_value=F.count(c), distinct=F.countDistinct(c), **more)


def overview(t: dict[str, DataFrame], llm: str = TARGET_LLM) -> dict[str, DataFrame]:
    """All sections of the statistics sheet from the fact tables; those whose tables are missing are left out."""
    out: dict[str, DataFrame] = {}

    def section(name: str, needs: tuple[str, ...], make) -> None:
        if all(n in t for n in needs):
            out[name] = make(*(t[n] for n in needs))

    def facts(b: DataFrame, p: DataFrame, k: DataFrame) -> DataFrame:
        own = k.filter(F.col("target_llm") == llm).select("barcode", F.col("count").alias("tokens"))
        return b.select("barcode").join(p.select("barcode", F.col("count_from_ocr").alias("pages")), "barcode", "left").join(own, "barcode", "left")

    base = ("books", "page_count", "token_count")
    section("BOOKS", base, lambda *x: books(facts(*x)))
    section("TOKEN COUNT", ("token_count",), lambda k: by(k, "target_llm", total=F.sum("count"), mean=F.avg("count")))
    section("TOKEN DISTRIBUTION", ("token_count",), lambda k: bins(k.filter(F.col("target_llm") == llm), "count", 100))
    section("PAGE COUNT", ("page_count",), lambda p: captioned(p, total=F.sum("count_from_ocr"), mean=F.avg("count_from_ocr")))
    section("PAGE DISTRIBUTION", ("page_count",), lambda p: bins(p, "count_from_ocr", 10))
    null = lambda c: F.count_if(F.col(c).isNull())
    section("MAIN LANGUAGE", ("main_language",), lambda m: captioned(m, distinct_metadata=F.countDistinct("from_metadata_iso639_2b"), distinct_detection=F.countDistinct("from_detection_iso639_3"), without_metadata=null("from_metadata_iso639_2b"), without_detection=null("from_detection_iso639_3")))
    section("MAIN LANGUAGE FROM METADATA", ("main_language",), lambda m: count_by(m.filter("from_metadata_iso639_2b <> ''"), "from_metadata_iso639_2b"))
    section("MAIN LANGUAGE FROM DETECTION", ("main_language",), lambda m: count_by(m.filter("from_detection_iso639_3 <> ''"), "from_detection_iso639_3"))
    section("LANGUAGE DETECTION", ("language_detection",), lambda d: captioned(d.filter("token_count > 1000"), distinct=F.countDistinct("iso639_3")))
    section("LANGUAGE DETECTION TOKENS", ("language_detection",), lambda d: d.filter("token_count > 5000").groupBy(F.col("iso639_3").alias("caption")).agg(F.sum("token_count").alias("value")))
    section("RIGHTS", (*base, "rights_determination"), lambda b, p, k, r: rights(facts(b, p, k).join(r.select("barcode", "htid", "rights_code", "us_rights_string"), "barcode", "left")))
    section("RIGHTS CODES", ("rights_determination",), lambda r: count_by(r.filter("rights_code is not null"), "rights_code"))
    section("RIGHTS REASONS", ("rights_determination",), lambda r: count_by(r.filter("reason_code is not null").select(F.upper("reason_code").alias("r")), "r"))
    section("YEARS", ("year_of_publication",), years)
    section("CENTURIES", ("year_of_publication",), by_century)
    section("DECADES", ("year_of_publication",), by_decade)
    section("OCR QUALITY", ("ocr_quality",), lambda q: captioned(q, mean_metadata=F.avg("from_metadata"), mean_detection=F.avg("from_detection"), without_metadata=null("from_metadata"), without_detection=null("from_detection")))
    section("OCR QUALITY BY DECADE", ("year_of_publication", "ocr_quality"), lambda y, q: melted(quality_by_decade(y, q), "decade"))
    section("DEDUPLICATION", ("scanned_text_simhash", "duplicate_groups"), lambda h, g: melted(dedup(h, g)))
    section("TEXT ANALYSIS", ("text_analysis",), lambda a: captioned(a, **{c: F.avg(c) for c in MEANS}))
    section("GENRES", ("genre_classification",), lambda g: with_value(g, "from_metadata"))
    section("TOP GENRES", ("genre_classification",), lambda g: top(g, "from_metadata"))
    section("TOPICS FROM METADATA", ("topic_classification",), lambda c: with_value(c, "from_metadata"))
    section("TOP TOPICS FROM METADATA", ("topic_classification",), lambda c: top(c, "from_metadata"))
    section("TOPICS FROM DETECTION", ("topic_classification",), lambda c: with_value(c, "from_detection", mean_confidence=F.avg("detection_confidence")))
    section("TOPICS FROM DETECTION BY TOPIC", ("topic_classification",), lambda c: by(c.filter("from_detection is not null"), "from_detection", books=F.count("*"), mean_confidence=F.avg("detection_confidence")))
    sets = "topic_classification_training_dataset"
    section("TOPIC TRAINING SETS", (sets,), lambda s: count_by(s, "set"))
    section("TOPIC TRAINING SETS BY TOPIC", (sets,), lambda s: s.groupBy(F.concat_ws(": ", "set", "target_topic").alias("caption")).agg(F.count("*").alias("value")))
    section("OCR POSTPROCESSING", ("ocr_postprocessed",), lambda p: captioned(p, books=F.count("*")))
    section("OCR POSTPROCESSING LINES", ("ocr_postprocessed",), line_types)
    section("OCR TRAINING SETS", ("ocr_postprocessing_training_dataset",), lambda x: set_counts(x, LINE_TYPES).select(F.concat_ws(": ", "set", "target_type").alias("caption"), F.col("n").alias("value")))
    both = ("text_analysis", "ocr_postprocessing_text_analysis")
    section("COMPARED BY LANGUAGE", (*both, "main_language"), lambda a, g, m: melted(compared(a, g, m, "from_detection_iso639_3"), "from_detection_iso639_3"))
    section("COMPARED BY DECADE", (*both, "year_of_publication"), lambda a, g, y: melted(compared(a, g, y, "decade"), "decade"))
    return out


def melted(df: DataFrame, key: str | None = None) -> DataFrame:
    """A wide frame as (caption, value) rows, a caption "key: column" where there is a key."""
    name = lambda c: F.concat(F.col(key).cast("string"), F.lit(f": {c}")) if key else F.lit(c)
    rows = F.array(*(F.struct(name(c).alias("caption"), F.col(c).cast("double").alias("value")) for c in df.columns if c != key))
    return df.select(F.explode(rows).alias("x")).select("x.*")


def sheet(sections: dict[str, DataFrame]) -> DataFrame:
    """All sections in one tidy frame, in order."""
    tidy = [d.select(F.lit(i).alias("ord"), F.lit(name).alias("section"), F.col("caption").cast("string"), F.col("value").cast("double"), (F.col("extra") if "extra" in d.columns else F.lit(None)).cast("string").alias("extra")) for i, (name, d) in enumerate(sections.items())]
    return reduce(DataFrame.unionByName, tidy)
