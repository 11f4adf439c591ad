"""Near-duplicate volumes by equal fingerprints, filtered by language and length."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch


def groups(hashes: DataFrame, languages: DataFrame, lengths: DataFrame, *, is_pd: DataFrame | None = None) -> DataFrame:
    """hash, barcode of the members that stay.

    In order: hashes of two books or more; open-access books only, if is_pd is given; the largest detected-language
    subgroup (no row is "und", null its own language; ties: the one with the smallest barcode); continuous length within
    15% of the group's median (zero lengths stay); groups of two or more.

    hashes should be a stored table. Books whose hash is repeated, few of all, are written with what the filters need, so
    that no step after that reads a large table again.
    """
    scratch = Scratch(hashes.sparkSession, "duplicates")
    d = hashes.filter("hash is not null").select("barcode", "hash")
    many = d.groupBy("hash").count().filter("count > 1").select("hash")
    d = d.join(many, "hash", "left_semi")
    if is_pd is not None:
        d = d.join(is_pd.filter("is_pd").select("barcode"), "barcode", "left_semi")
    lang = languages.select("barcode", F.coalesce("from_detection_iso639_3", F.lit("null")).alias("lang"))
    d = d.join(lang, "barcode", "left").join(lengths.select("barcode", F.col("char_count_continuous").alias("n")), "barcode", "left")
    d = scratch.write(d.select("hash", "barcode", F.coalesce("lang", F.lit("und")).alias("lang"), "n"), "members")
    # per (hash, language): its size, first barcode and median, then one language per hash; a row per pair, not per book
    by = d.groupBy("hash", "lang").agg(F.count("*").alias("size"), F.min("barcode").alias("first"), F.percentile("n", F.lit(0.5)).alias("median"))
    best = by.groupBy("hash").agg(F.min_by(F.struct("lang", "median"), F.struct(-F.col("size"), F.col("first"))).alias("b")).select("hash", "b.lang", "b.median")
    d = d.join(best, ["hash", "lang"]).filter((F.coalesce("n", F.lit(0)) == 0) | ((F.col("n") <= F.floor(F.col("median") * 1.15)) & (F.col("n") >= F.floor(F.col("median") / 1.15))))
    d = scratch.write(d.select("hash", "barcode"), "alike")
    left = d.groupBy("hash").count().filter("count > 1").select("hash")
    return d.join(left, "hash", "left_semi").select("hash", "barcode")


def classes(hashes: DataFrame, found: DataFrame) -> DataFrame:
    """barcode, the group's first member and its number of members: linear in the group's size, unlike likely_duplicates()."""
    per = found.groupBy("hash").agg(F.min("barcode").alias("representative"), F.count("*").alias("members"))
    return hashes.select("barcode", "hash").join(per, "hash").select("barcode", "representative", "members")


def likely_duplicates(hashes: DataFrame, found: DataFrame) -> DataFrame:
    """barcode and the other members of its hash's group; null without a group. Rejected members get the group too."""
    lists = found.groupBy("hash").agg(F.sort_array(F.collect_list("barcode")).alias("members"))
    d = hashes.select("barcode", "hash").join(lists, "hash", "left")
    return d.select("barcode", F.filter("members", lambda x: x != F.col("barcode")).alias("likely_duplicates"))


def evaluation_sheet(found: DataFrame, samples: int, seed: int = 0) -> DataFrame:
    """A seeded sample of groups, with up to 20 members each in columns."""
    lists = found.groupBy("hash").agg(F.sort_array(F.collect_list("barcode")).alias("m"))
    picked = lists.orderBy(F.md5(F.concat("hash", F.lit(str(seed)))), "hash").limit(samples)
    return picked.select("hash", *(F.get("m", F.lit(i)).alias(f"book_{i + 1}") for i in range(20)))


