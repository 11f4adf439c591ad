"""The command line from an empty folder to a checked publication, every command twice, in and out being one folder."""

import json
import random

import pytest

from bookweave import cli, sources

N = 14
R = random.Random(3)
WORDS = "the and of to in is that for with was house river stone letter window garden morning people answer water".split()


def page(k):
    return "\n".join(" ".join(R.choice(WORDS) for _ in range(9)) + "." for _ in range(k))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("books")
    rows = ["Barcode,Sync Timestamp,Enrichment Timestamp,MARC Title,MARC Title Remainder,MARC Author Personal,MARC Date 1,MARC Date 2,MARC Date Type,MARC Language,MARC Subjects,MARC Genres,MARC General Note,MARC LCCN,MARC ISBN,MARC OCLC Numbers,OCR Score,MARC OCoLC"]
    (at / "rights").mkdir()
    for i in range(N):
        rows.append(f'b{i},2024-01-02 03:04:05,,"Title {i} /",,"Author, {i},",{1800 + 10 * i},,Single,eng,{("Music", "Law")[i % 2]},Fiction,," a,b ",,,{50 + i},"1, 2"')
        pages = [page(12) for _ in range(3)] if i != 13 else text
        if i == 12:
            text = pages  # book 13 is a copy of book 12
        (at / f"b{i}_ocr.jsonl").write_text("\n".join(json.dumps(p) for p in pages) + "\n\n")
        xml = f'<record><datafield tag="974"><subfield code="u">lib.b{i}</subfield><subfield code="q">bib</subfield></datafield></record>'
        item = {"htid": f"lib.B{i}", "fromRecord": "7", "rightsCode": "pd" if i else "ic", "lastUpdate": "20240304", "enumcron": False, "usRightsString": "Full view"}
        (at / "rights" / f"b{i}.json").write_text(json.dumps({"records": {"7": {"marc-xml": xml}}, "items": [item]}))
    (at / "catalogue.csv").write_text("\n".join(rows) + "\n")
    return at


SIZES = ["--sizes", "2", "2", "4", "--least-train", "2"]
STEPS = [
    ["analyze", "extract-genre"], ["analyze", "extract-topic"], ["analyze", "extract-year"], ["analyze", "extract-ocr-quality"], ["analyze", "extract-main-language"], ["analyze", "extract-page-count"], ["analyze", "extract-rights"],
    ["analyze", "run-language-detection", "--chunk-size", "200"], ["analyze", "run-ocr-quality-detection"], ["analyze", "run-simhash"], ["analyze", "run-text-analysis"], ["analyze", "run-token-count"],
    ["analyze", "extract-topic-training-set", *SIZES], ["analyze", "train-topic-classification"], ["analyze", "run-topic-classification", *SIZES], ["analyze", "find-duplicates"],
    ["process", "sample-ocr", "--samples", "10", "--least-words", "10"], ["process", "ocr"], ["analyze", "run-text-analysis", "--use-postprocessed"],
    ["export", "overview"], ["export", "dedup-sheet"], ["export", "simplified-metadata", "--pd-only"], ["export", "topic-training-sets"], ["publish", "generate", "--pd-only"], ["publish", "push"], ["publish", "check-integrity", "--pd-only"],
]


def test_from_catalogue_to_checked_publication(spark, folder, capsys):
    out = str(folder / "t")
    run = lambda *c: cli.main([*c, "--in", out, "--out", out])
    assert run("analyze", "extract-genre") == 1  # nothing is built yet
    build = ["setup", "build", "--in", str(folder), "--out", out]
    assert cli.main(build) == 0 and cli.main(build) == 1 and cli.main([*build, "--overwrite"]) == 0
    (folder / "rights").rename(folder / "t" / "rights")
    assert run("analyze", "run-text-analysis") == 1  # languages come first
    for step in STEPS:
        assert run(*step) == 0, (step, capsys.readouterr().err)
        assert run(*step) == 0, step
        if step[1] in ("extract-genre", "run-token-count", "run-language-detection", "extract-rights"):
            assert run(*step, "--overwrite") == 0, step
    t = lambda name: spark.read.parquet(f"{out}/{name}")
    for name in ("genre_classification", "year_of_publication", "main_language", "token_count", "scanned_text_simhash", "text_analysis", "rights_determination", "topic_classification", "ocr_quality", "ocr_postprocessed", "page_count"):
        assert t(name).count() == N, name
    assert {r.reason_code for r in t("rights_determination").collect()} == {"bib"} and t("rights_determination").filter("retrieved_date is null or enumcron is not null").count() == 0
    assert {r.from_detection_iso639_3 for r in t("main_language").collect()} == {"eng"}
    assert t("topic_classification").filter("detection_confidence between 0 and 1 and from_detection in ('MUSIC AND BOOKS ON MUSIC', 'LAW')").count() == N
    assert [r.likely_duplicates for r in t("likely_duplicates").filter("barcode in ('b12', 'b13')").orderBy("barcode").collect()] == [["b13"], ["b12"]]
    published = t("published")
    assert published.count() == N - 1 and published.filter("rights_ext.reason_code = 'bib' and title_src like 'Title%' and language_gen = 'eng' and size(text_by_page_gen) = 3").count() == N - 1
    files = sorted(p.name for p in (folder / "t" / "pushed").glob("*.parquet"))
    assert files[0] == f"train-00000-of-{len(files):05}.parquet" and spark.read.parquet(f"{out}/pushed").count() == N - 1
    sheet = spark.read.csv(f"{out}/overview", header=True)
    assert {"BOOKS", "TOKEN DISTRIBUTION", "LANGUAGE DETECTION", "TOPICS FROM DETECTION", "OCR TRAINING SETS", "COMPARED BY DECADE"} <= {r.section for r in sheet.collect()}
    assert len(spark.read.csv(f"{out}/simplified_metadata", header=True).columns) == 39
    assert {r["set"] for r in spark.read.csv(f"{out}/topic_training_sets", header=True).collect()} == {"benchmark", "test", "train"}
    assert run("analyze", "run-topic-classification", "--benchmark", *SIZES) == 0 and len(list((folder / "t").glob("topic-classification-benchmark-topic-model-*"))) == 1
    assert run("analyze", "run-topic-classification") == 1  # too few books for the default sizes
    # a changed table is noticed
    t("year_of_publication").limit(3).write.parquet(f"{out}/short")
    sources.replace(spark.read.parquet(f"{out}/short"), f"{out}/year_of_publication")
    assert run("publish", "generate", "--pd-only") == 1 and published.count() == N - 1
    assert run("setup", "status") == 0 and "year_of_publication\t3" in capsys.readouterr().out
    assert run("setup", "clear", "--table", "year_of_publication") == 1
    assert run("setup", "clear", "--table", "year_of_publication", "--yes") == 0 and not sources.exists(spark, f"{out}/year_of_publication")
    assert run("setup", "clear", "--table", "catalogue", "--yes") == 1 and run("setup", "ocr") == 2


def test_a_failed_run_leaves_the_old_table(spark, tmp_path):
    from pyspark.sql import functions as F

    at = str(tmp_path / "t")
    sources.replace(spark.range(5), at)
    with pytest.raises(Exception, match="stop"):
        sources.replace(spark.read.parquet(at).withColumn("id", F.when(F.col("id") == 3, F.raise_error(F.lit("stop"))).otherwise(F.col("id"))), at)
    assert spark.read.parquet(at).count() == 5 and [p.name for p in tmp_path.iterdir()] == ["t"]
    sources.replace(spark.read.parquet(at).filter("id < 2"), at)
    assert spark.read.parquet(at).count() == 2
    (tmp_path / "t").rename(tmp_path / "t.old")  # cut off between the renames
    sources.recover(spark, at)
    assert spark.read.parquet(at).count() == 2 and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_shards_can_be_taken_up(spark, tmp_path):
    at = str(tmp_path / "p")
    d = spark.range(0, 250, 1, 1).toDF("n")
    assert sources.write_records(d, at, skip=2) == 3
    assert [p.name for p in sorted((tmp_path / "p").glob("*.parquet"))] == ["train-00002-of-00003.parquet"]
    assert sources.write_records(d, at) == 3 and spark.read.parquet(at).count() == 250


def test_annotation_and_classifier(spark, tmp_path):
    from pyspark.sql import functions as F

    from bookweave.operators import ocr as O

    pages = [page(8) for _ in range(6)]
    rows = O.annotation_context(O.lines(spark.createDataFrame([("b", pages)], "barcode string, text_by_page array<string>"))).withColumn("language", F.lit("eng"))
    got = rows.filter("page_number = 1 and line_number in (2, 7)").orderBy("line_number").select(O.annotation_markup().alias("m"), O.annotation_prompt().alias("p")).collect()
    assert got[0].m.startswith("<context>Page 2 of 6, Line 3 of 8, Language: eng</context>\n<current>") and "<next>" in got[0].m and "<previous>" in got[1].m
    assert "PAGE_NUMBER" in got[0].p and "RUNNING_HEAD" not in got[0].p
    said = spark.createDataFrame([("It is PARAGRAPH_END here",), ("A" * 200 + "a",), ("NOT_A_TYPE",), ("no",), (None,)], "r string").select(O.reply_type(F.col("r")).alias("t")).collect()
    assert [r.t for r in said] == ["PARAGRAPH_END", None, None, None, None]
    shaped = O.lines(spark.createDataFrame([("b", ["\n".join(["HEAD OF IT", "some words run on here", "and end."])] * 40)], "barcode string, text_by_page array<string>"))
    kinds = F.when(F.col("line_number") == 1, "HEADING_OR_TITLE").when(F.col("line_number") == 2, "PARAGRAPH_CHUNK").otherwise("PARAGRAPH_END")
    shaped = shaped.withColumn("target_type", kinds).withColumn("set", F.when(F.col("page_number") % 4 == 0, "test").otherwise("train"))
    sources.save_model(O.train_classifier(shaped, 1 << 10), str(tmp_path / "m"))
    model = sources.load_model(str(tmp_path / "m"))
    found = O.evaluation(model, shaped).collect()
    assert len(found) == 3 and all(r.support == 10 and r.f1 > 0.9 for r in found)
    assert O.classified_by(model, shaped.drop("target_type").withColumn("target_type", F.lit(None).cast("string"))).filter("target_type is null").count() == 0


def test_counters_slugs_and_languages(spark, tmp_path):
    from bookweave.functions import text as T
    from bookweave.operators import metadata as M

    try:
        import public_tokenizers as P
    except ImportError:
        pytest.skip("no vocabulary files")
    books = spark.createDataFrame([("a", ["one two", "three"]), ("b", [" ", ""]), ("c", None)], "barcode string, text_by_page array<string>")
    for name in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"):
        got = {r.barcode: r["count"] for r in T.tokens(books, tokenizer=name, counter=T.vocabulary(P.path(name))).collect()}
        assert got == {"a": 3, "b": 0, "c": 0}, name
    assert T.slug("Org/Model Näme: 2.5") == "org-model-name-2-5" and len(T.time_slug()) == 16
    table = {r.pt2b: r for r in M.iso639(spark).collect()}
    assert len(table) > 150 and (table["ger"].pt1, table["ger"].pt3, table["ger"].name) == ("de", "deu", "German") and table["lat"].name == "Latin" and table["dut"].pt3 == "nld"
    (tmp_path / "r.txt").write_text("ang|||English, Old (ca.450-1100)|anglo-saxon\nfre|fra|fr|French|français\nqaa-qtz|||Reserved|x\n")
    assert sorted(tuple(r) for r in M.iso639(spark, str(tmp_path / "r.txt")).collect() if r.pt1) == [("fr", "fre", "fra", "French")]
    assert {r.pt3 for r in M.iso639(spark, str(tmp_path / "r.txt")).collect()} == {"ang", "fra"}
