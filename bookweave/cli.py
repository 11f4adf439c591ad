"""Command line: ``python -m bookweave.cli GROUP COMMAND --in DIR --out DIR [options]``.

Inputs and outputs are folders of tables, local or on any Hadoop file system, and may be the same folder. ``catalogue`` and
``pages`` (barcode, text_by_page) are Parquet tables written by ``setup build`` from a catalogue in CSV and page files;
every other command reads and writes fact tables by the names of schemas.TABLES. A table is replaced only after the new
one has been written whole. Commands check that the tables they need are complete.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import sources
from .functions import simhash, text
from .operators import dedup, incremental, language, metadata, ocr, publish, topics
from .plans import stats
from .schemas import TABLES, TARGET_LLM
from .scratch import remove
from .session import session, ship


class Job:
    def __init__(self, spark: SparkSession, args: argparse.Namespace):
        self.spark, self.args = spark, args

    def table(self, name: str) -> DataFrame:
        if not self.has(name):
            raise ValueError(f"{name} is missing in {self.args.input}: run the command that makes it first")
        return self.spark.read.parquet(f"{self.args.input}/{name}")

    def has(self, name: str) -> bool:
        sources.recover(self.spark, f"{self.args.input}/{name}")
        return sources.ready(self.spark, f"{self.args.input}/{name}")

    def books(self) -> DataFrame:
        """The catalogue, windowed by --offset and --limit."""
        c = self.table("catalogue")
        return incremental.window(c, self.args.offset, self.args.limit) if self.args.offset or self.args.limit else c

    def page_texts(self) -> DataFrame:
        pages = self.table("ocr_postprocessed" if self.args.use_postprocessed else "pages")
        return pages.join(self.books().select("barcode"), "barcode", "left_semi").select("barcode", "text_by_page")

    def texts(self) -> DataFrame:
        return self.page_texts().select("barcode", F.array_join("text_by_page", "\n").alias("text"))

    def languages(self) -> DataFrame:
        return metadata.iso639(self.spark, self.args.registry)

    def write(self, df: DataFrame, name: str) -> None:
        sources.replace(df, f"{self.args.output}/{name}")

    def facts(self, name: str, compute: Callable[[DataFrame], DataFrame], of: DataFrame, *, schema: str | None = None) -> None:
        """Books that have rows are skipped unless --overwrite, which replaces all rows of the books it is run on.

        The written table has the columns of schemas.TABLES, in that order; what compute() lacks is null.
        """
        new = lambda books: conformed(compute(books), schema or TABLES[name])
        if not self.has(name):
            return self.write(new(of), name)
        old = conformed(self.table(name), schema or TABLES[name])
        if self.args.overwrite:
            return self.write(incremental.delete_insert(old, of, new(of)), name)
        return self.write(old.unionByName(new(incremental.missing(of, old))), name)

    def complete(self, *names: str) -> None:
        """ValueError unless each of these tables has as many rows as there are books."""
        incremental.require({n: self.table(n) for n in names}, self.table("catalogue"))

    def some(self, **present: str) -> None:
        """ValueError unless each table has a value in that column somewhere."""
        incremental.require({}, self.table("catalogue"), present={n: (self.table(n), c) for n, c in present.items()})

    def is_pd(self) -> DataFrame:
        if self.args.exclusions:
            return metadata.is_pd(self.table("catalogue"), "list", excluded=sources.exclusions(self.spark, self.args.exclusions))
        return metadata.is_pd(self.table("catalogue"), "rights", rights=self.table("rights_determination"))


def conformed(df: DataFrame, schema: str) -> DataFrame:
    """df with exactly the columns of a schema, cast to its types; missing ones are null."""
    fields = T.StructType.fromDDL(schema).fields
    return df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields))


def build(j: Job) -> None:
    if not j.args.overwrite and sources.ready(j.spark, f"{j.args.output}/catalogue"):
        raise ValueError("the index is there already; --overwrite builds it anew")
    d = sources.catalogue(j.spark, f"{j.args.input}/catalogue*.csv*")
    j.write(d, "catalogue")
    if {"sync_timestamp", "enrichment_timestamp"} <= set(d.columns):
        j.write(metadata.index(j.spark.read.parquet(f"{j.args.output}/catalogue")), "books")
    j.write(sources.pages(j.spark, f"{j.args.input}/*_ocr.jsonl*"), "pages")


def status(j: Job) -> None:
    for name, n in incremental.status({n: j.table(n) for n in ("catalogue", "pages", "ocr_postprocessed", *TABLES) if j.has(n)}).items():
        print(f"{name}\t{n}")


def clear(j: Job) -> None:
    """Delete fact tables (all, or --table NAME), after --yes; what setup build wrote stays."""
    names = [j.args.table] if j.args.table else [n for n in (*TABLES, "ocr_postprocessed", "duplicate_groups", "likely_duplicates") if n != "books"]
    if unknown := set(names) - {*TABLES, "ocr_postprocessed", "duplicate_groups", "likely_duplicates"}:
        raise ValueError(f"no such table: {', '.join(unknown)}")
    found = [n for n in names if sources.exists(j.spark, f"{j.args.output}/{n}")]
    if not j.args.yes:
        raise ValueError(f"this deletes {', '.join(found) or 'nothing'}; say --yes")
    for n in found:
        remove(j.spark, f"{j.args.output}/{n}")


def main_language(j: Job) -> None:
    detected = language.main(j.table("language_detection")) if j.has("language_detection") else None
    j.facts("main_language", lambda b: metadata.main_language(b, j.languages(), detected), j.books())


def detect_languages(j: Job) -> None:
    j.complete("main_language")
    j.facts("language_detection", lambda t: language.detections(t, j.languages(), size=j.args.chunk_size), j.texts())
    # the detected main language follows: rows of the books just read are replaced
    found = language.main(j.spark.read.parquet(f"{j.args.output}/language_detection"))
    j.write(conformed(metadata.main_language(j.table("catalogue"), j.languages(), found), TABLES["main_language"]), "main_language")


def text_analysis(j: Job) -> None:
    j.complete("main_language")
    j.some(main_language="from_detection_iso639_3")
    j.facts("ocr_postprocessing_text_analysis" if j.args.use_postprocessed else "text_analysis", text.metrics, j.texts())


def ocr_quality(j: Job) -> None:
    j.complete("ocr_quality")
    found = language.ocr_quality(j.texts()).withColumn("detection_source", F.lit("detector"))
    old = conformed(j.table("ocr_quality"), TABLES["ocr_quality"])
    own = j.books().select("barcode").withColumn("_own", F.lit(True))
    d = old.join(own, "barcode", "left").join(found.withColumnsRenamed({"from_detection": "_d", "detection_source": "_s"}), "barcode", "left")
    pick = lambda new, c: F.when(F.col("_own") & F.col(new).isNotNull(), F.col(new)).otherwise(F.col(c)).alias(c)
    j.write(d.select("barcode", "from_metadata", "metadata_source", pick("_d", "from_detection"), pick("_s", "detection_source")), "ocr_quality")


def token_count(j: Job) -> None:
    """Rows of other tokenizers stay: a book has a row per tokenizer."""
    path = j.args.vocabulary
    name = path.rpartition("/")[2] if path else "pieces4"
    counter = text.vocabulary(path) if path else None
    count = lambda t: conformed(text.tokens(t, target_llm=j.args.target_llm, tokenizer=name, counter=counter), TABLES["token_count"])
    if not j.has("token_count"):
        return j.write(count(j.page_texts()), "token_count")
    old = j.table("token_count")
    mine = old.filter(F.col("tokenizer") == name)
    rest, texts = old.filter(F.col("tokenizer") != name), j.page_texts()
    if j.args.overwrite:
        return j.write(rest.unionByName(incremental.delete_insert(mine, texts, count(texts))), "token_count")
    return j.write(old.unionByName(count(incremental.missing(texts, mine))), "token_count")


def topic_sets(j: Job) -> None:
    j.complete("topic_classification")
    sizes = dict(zip(("benchmark", "test", "least"), j.args.sizes, strict=True))
    j.write(topics.training_set(j.table("topic_classification"), topics.dictionary(j.spark), **sizes), "topic_classification_training_dataset")


def prompts(j: Job) -> DataFrame:
    return metadata.prompt(j.table("catalogue"), j.languages(), skip_topic=True, skip_genre=True)


def train_topics(j: Job) -> None:
    sets = j.table("topic_classification_training_dataset").filter("set = 'train'")
    sources.save_model(topics.train(prompts(j).join(sets, "barcode").filter("prompt is not null").select("prompt", "target_topic")), f"{j.args.output}/topic_model")


def detect_topics(j: Job) -> None:
    """Classify all books, or with --benchmark the benchmark set alone, whose answers become a sheet."""
    sets, b, t = j.table("topic_classification_training_dataset"), *j.args.sizes[:2]
    topics.require(sets, benchmark=b, test=t, train=j.args.least_train)
    j.complete("topic_classification")
    model, p = sources.load_model(f"{j.args.input}/topic_model"), prompts(j)
    if j.args.benchmark:
        own = p.join(sets.filter("set = 'benchmark'").select("barcode"), "barcode", "left_semi")
        rows = topics.benchmark_rows(p, topics.infer(own, model=model), sets, "topic_model")
        return sources.write_sheet(rows, f"{j.args.output}/topic-classification-benchmark-{text.slug('topic_model')}-{text.time_slug()}")
    found = topics.infer(p.join(j.books().select("barcode"), "barcode", "left_semi"), model=model)
    old = conformed(j.table("topic_classification"), TABLES["topic_classification"])
    new = {c: f"_{c}" for c in ("from_detection", "detection_source", "detection_confidence")}
    d = old.join(found.withColumnsRenamed(new), "barcode", "left")
    return j.write(d.select("barcode", "from_metadata", "metadata_source", *(F.when(F.col("_from_detection").isNotNull(), F.col(n)).otherwise(F.col(c)).alias(c) for c, n in new.items())), "topic_classification")


def ocr_sample(j: Job) -> None:
    """Lines of a random page of --samples books; those that rules can tell have a type, the others wait for an annotator."""
    j.complete("page_count", "text_analysis")
    j.some(main_language="from_detection_iso639_3")
    picked = ocr.sample(j.table("page_count"), j.table("main_language"), j.table("text_analysis"), j.is_pd(), n=j.args.samples, among=tuple(j.args.language), least=j.args.least_words)
    lines = ocr.lines(j.table("pages").join(picked.select("barcode"), "barcode", "left_semi"))
    j.write(conformed(lines.join(picked, ["barcode", "page_number"]).withColumn("target_type", ocr.prelabel()), TABLES["ocr_postprocessing_training_dataset"]), "ocr_postprocessing_training_dataset")


def ocr_train(j: Job) -> None:
    j.some(ocr_postprocessing_training_dataset="target_type")
    rows = j.table("ocr_postprocessing_training_dataset")
    model = ocr.train_classifier(rows)
    sources.save_model(model, f"{j.args.output}/ocr_model")
    for r in ocr.evaluation(model, rows).orderBy("target_type").collect():
        print(f"{r.target_type}\t{r.precision:.3f}\t{r.recall:.3f}\t{r.f1:.3f}\t{r.support}")


def ocr_process(j: Job) -> None:
    """Books in the languages that the heuristics were made for. With a model of train-ocr, it tells the lines' types; else rules do."""
    books = j.books()
    if j.has("main_language"):
        books = books.join(j.table("main_language").filter(F.coalesce("from_detection_iso639_3", "from_metadata_iso639_3").isin(*ocr.PROCESSED_LANGUAGES)).select("barcode"), "barcode", "left_semi")

    def process(some: DataFrame) -> DataFrame:
        lines = ocr.lines(j.table("pages").join(some.select("barcode"), "barcode", "left_semi"))
        trained = sources.exists(j.spark, f"{j.args.input}/ocr_model")
        return ocr.postprocess(ocr.classified_by(sources.load_model(f"{j.args.input}/ocr_model"), lines) if trained else ocr.classified(lines))

    j.facts("ocr_postprocessed", process, books, schema=sources.POSTPROCESSED)


def duplicates(j: Job) -> None:
    j.complete("scanned_text_simhash", "text_analysis")
    only = j.is_pd() if j.args.pd_only else None
    hashes = j.table("scanned_text_simhash")
    j.write(dedup.groups(hashes, language.main(j.table("language_detection")), j.table("text_analysis"), is_pd=only), "duplicate_groups")
    found = j.spark.read.parquet(f"{j.args.output}/duplicate_groups")
    j.write(dedup.likely_duplicates(hashes, found), "likely_duplicates")


def overview(j: Job) -> None:
    names = (*TABLES, "duplicate_groups", "ocr_postprocessed")
    t = {n: j.table(n) for n in names if j.has(n)}
    t.setdefault("books", j.table("catalogue"))
    sources.write_sheet(stats.sheet(stats.overview(t, j.args.target_llm)), f"{j.args.output}/overview")


def training_export(j: Job) -> None:
    sources.write_training_sets(j.table("topic_classification_training_dataset").join(prompts(j), "barcode"), f"{j.args.output}/topic_training_sets")


NEEDED = ("page_count", "year_of_publication", "main_language", "topic_classification", "genre_classification", "ocr_quality", "scanned_text_simhash", "text_analysis", "rights_determination")


def records(j: Job) -> DataFrame:
    j.complete(*NEEDED)
    t = {n: j.table(n) for n in ("catalogue", *NEEDED, "language_detection", "likely_duplicates", "token_count")}
    t["token_count"] = t["token_count"].filter(F.col("target_llm") == j.args.target_llm)
    empty = lambda schema: j.spark.createDataFrame([], schema)
    t["ocr_postprocessing_text_analysis"] = j.table("ocr_postprocessing_text_analysis") if j.has("ocr_postprocessing_text_analysis") else empty(TABLES["text_analysis"])
    done = sources.postprocessed(j.spark, f"{j.args.input}/ocr_postprocessed") if j.has("ocr_postprocessed") else empty(sources.POSTPROCESSED)
    t["pages"] = j.table("pages").select("barcode", F.col("text_by_page").alias("text_by_page_src")).join(done.select("barcode", F.col("text_by_page").alias("text_by_page_gen")), "barcode", "left")
    t["rights"], t["is_pd"] = t["rights_determination"], j.is_pd()
    return publish.rows(t, include_text=not j.args.without_text, pd_only=j.args.pd_only)


def check_integrity(j: Job) -> None:
    """Column by column, how many published records differ from what the tables now give."""
    found = publish.integrity(j.spark.read.parquet(f"{j.args.output}/published"), records(j))
    bad = 0
    for r in found.collect():  # a row per column
        print(f"{r['column']}\t{r.different}")
        bad += r.different
    if bad:
        raise ValueError(f"{bad} differences")


COMMANDS: dict[tuple[str, str], Callable[[Job], None]] = {
    ("setup", "build"): build,
    ("setup", "status"): status,
    ("setup", "clear"): clear,
    ("analyze", "extract-genre"): lambda j: j.facts("genre_classification", metadata.genre, j.books()),
    ("analyze", "extract-topic"): lambda j: j.facts("topic_classification", metadata.topic, j.books()),
    ("analyze", "extract-year"): lambda j: j.facts("year_of_publication", metadata.year, j.books()),
    ("analyze", "extract-ocr-quality"): lambda j: j.facts("ocr_quality", metadata.ocr_quality, j.books()),
    ("analyze", "extract-main-language"): main_language,
    ("analyze", "extract-page-count"): lambda j: j.facts("page_count", lambda b: b.select("barcode").join(j.table("pages"), "barcode", "left").select("barcode", F.coalesce(F.size("text_by_page"), F.lit(0)).alias("count_from_ocr")), j.books()),
    ("analyze", "extract-rights"): lambda j: j.facts("rights_determination", lambda b: metadata.rights(b, sources.rights(j.spark, f"{j.args.input}/rights/*.json", j.args.prefix)), j.books()),
    ("analyze", "extract-topic-training-set"): topic_sets,
    ("analyze", "train-topic-classification"): train_topics,
    ("analyze", "run-topic-classification"): detect_topics,
    ("analyze", "run-language-detection"): detect_languages,
    ("analyze", "run-ocr-quality-detection"): ocr_quality,
    ("analyze", "run-simhash"): lambda j: j.facts("scanned_text_simhash", lambda t: simhash.fingerprints(t, j.args.shingle_width), j.texts()),
    ("analyze", "run-text-analysis"): text_analysis,
    ("analyze", "run-token-count"): token_count,
    ("analyze", "find-duplicates"): duplicates,
    ("process", "sample-ocr"): ocr_sample,
    ("process", "train-ocr"): ocr_train,
    ("process", "ocr"): ocr_process,
    ("export", "overview"): overview,
    ("export", "dedup-sheet"): lambda j: sources.write_sheet(dedup.evaluation_sheet(j.table("duplicate_groups"), j.args.samples), f"{j.args.output}/dedup_sheet"),
    ("export", "simplified-metadata"): lambda j: sources.write_export(publish.simplified(j.table("catalogue"), j.is_pd() if j.args.pd_only else None, prefix=j.args.prefix), f"{j.args.output}/simplified_metadata"),
    ("export", "topic-training-sets"): training_export,
    ("publish", "generate"): lambda j: j.write(records(j), "published"),
    ("publish", "push"): lambda j: print(sources.write_records(j.table("published"), f"{j.args.output}/pushed", with_text=not j.args.without_text, skip=j.args.skip)),
    ("publish", "check-integrity"): check_integrity,
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="bookweave", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("group", choices=sorted({g for g, _ in COMMANDS}))
    p.add_argument("command", choices=sorted({c for _, c in COMMANDS}))
    p.add_argument("--in", dest="input", required=True)
    p.add_argument("--out", dest="output", required=True)
    for flag in ("--overwrite", "--use-postprocessed", "--yes", "--benchmark", "--pd-only", "--without-text"):
        p.add_argument(flag, action="store_true")
    for name, default in (("--offset", None), ("--limit", None), ("--chunk-size", 768), ("--shingle-width", 7), ("--samples", 100), ("--least-words", 1000), ("--least-train", 6000), ("--skip", 0)):
        p.add_argument(name, type=int, default=default)
    p.add_argument("--sizes", type=int, nargs=3, default=topics.SIZES, metavar=("BENCHMARK", "TEST", "LEAST"))
    p.add_argument("--language", nargs="+", default=["eng"])
    p.add_argument("--target-llm", default=TARGET_LLM)
    p.add_argument("--prefix", default="lib")
    p.add_argument("--table", help="the table that setup clear deletes")
    p.add_argument("--vocabulary", help="a vocabulary file that all workers can read (.tiktoken, .json, .model)")
    p.add_argument("--registry", help="the language standard's registry file, in place of the JVM's languages")
    p.add_argument("--exclusions", help="books not on this list are open access, in place of their rights")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    run = COMMANDS.get((args.group, args.command))
    if run is None:
        print(f"{args.group} has no command {args.command}", file=sys.stderr)
        return 2
    spark = session()
    ship(spark)
    try:
        run(Job(spark, args))
    except ValueError as e:
        print(e, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
