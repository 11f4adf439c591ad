"""Hand-written cases of the book operators, and what SQL can't say."""

import io
import json
import random
import tarfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bookweave import sources, streaming
from bookweave.functions import text as T
from bookweave.functions.simhash import simhash
from bookweave.operators import dedup, incremental, language, publish, topics
from bookweave.operators import metadata as M
from bookweave.operators import ocr as O
from bookweave.plans import stats


def test_text_metrics(spark):
    rows = [("a", ""), ("b", "Word"), ("c", "foo\nbar"), ("d", "x​y\tz — w-v"), ("e", None), ("f", "One two. Two one! One")]
    got = {r.barcode: r for r in T.metrics(spark.createDataFrame(rows, "barcode string, text string")).collect()}
    assert (got["a"].char_count, got["a"].word_count, got["a"].tokenizability) == (0, None, None) and got["e"].char_count == 0
    assert got["b"].word_count == 1 and got["b"].bigram_count is None
    assert got["c"].word_count == 1 and got["d"].char_count_continuous == 5
    assert (got["f"].sentence_count, got["f"].word_count, got["f"].word_count_unique) == (3, 7, 4)


def test_years(spark):
    cases = [("19uu", "1850", "Single"), ("9999", "", "Single"), ("1901", "", "Single"), ("1850", "", "Continuing resource x"), (None, None, None), ("190", "19000", "Single"), ("1999", "", "No attempt to code")]
    d = spark.createDataFrame([(str(i), *c) for i, c in enumerate(cases)], "barcode string, marc_date_1 string, marc_date_2 string, marc_date_type string")
    got = [(r.year, r.decade, r.century, r.source_field) for r in M.year(d).orderBy("barcode").collect()]
    assert got[0] == (1850, 1850, 1800, "MARC Date 2") and got[2] == (1901, 1900, 1900, "MARC Date 1")
    assert all(got[i] == (None, None, None, None) for i in (1, 3, 4, 5, 6))


def test_scores_and_identifiers(spark):
    d = spark.createDataFrame([("1", " 7 "), ("2", "+1_0"), ("3", "x"), ("4", ""), ("5", "99999999999")], "barcode string, ocr_score string")
    assert [r.from_metadata for r in M.ocr_quality(d).orderBy("barcode").collect()] == [7, 10, None, None, None]
    i = spark.createDataFrame([(" a, ,b ",), (None,)], "c string").select(M.identifiers("c").alias("x")).collect()
    assert [r.x for r in i] == [["a", "b"], []]
    t = spark.createDataFrame([(" A title / ", None, "B,")], "a string, b string, c string").select(M.clean_title("a", "b", drop="/").alias("t"), M.clean_title("c", drop=",").alias("u")).first()
    assert tuple(t) == ("A title", "B")


def test_rights(spark, tmp_path):
    doc = {"records": {"1": {"marc-xml": "<x/>"}}, "items": [{"htid": "lib.B1", "fromRecord": "1", "rightsCode": "pd", "lastUpdate": "20240115", "enumcron": "", "usRightsString": "Limited"}]}
    (tmp_path / "b1.json").write_text(json.dumps(doc))
    got = M.rights(spark.createDataFrame([("b1",), ("b2",)], "barcode string"), sources.rights(spark, str(tmp_path / "*.json"), "lib")).orderBy("barcode").collect()
    assert (got[0].rights_code, got[0].last_update_year, got[0].last_update_month, got[0].enumcron) == ("pd", 2024, 1, None) and got[1].rights_code is None
    d = spark.createDataFrame([("b1", "pd", "Limited"), ("b2", None, None)], "barcode string, rights_code string, us_rights_string string")
    assert [r.is_pd for r in M.is_pd(d, "rights", rights=d).collect()] == [False, False]
    with pytest.raises(ValueError):
        M.is_pd(d, "other")
    xml = '<r><datafield tag="974"><subfield code="u">v</subfield><subfield code="q">bib</subfield></datafield><datafield tag="974"><subfield code="u">v</subfield><subfield code="q">ren</subfield></datafield></r>'
    assert spark.createDataFrame([(xml, "v")], "x string, h string").select(M.reason_code(F.col("x"), "h")).first()[0] == "ren"


def test_duplicate_groups(spark):
    h = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1"), ("d", "2"), ("e", "3"), ("f", "3"), ("g", "4"), ("h", "4"), ("i", None)], "barcode string, hash string")
    lang = spark.createDataFrame([("a", "eng"), ("b", "eng"), ("c", "fra"), ("e", "eng"), ("f", None), ("g", None), ("h", None)], "barcode string, from_detection_iso639_3 string")
    n = spark.createDataFrame([("a", 100), ("b", 115), ("c", 100), ("e", 5), ("f", 5), ("g", 0), ("h", 1000)], "barcode string, char_count_continuous long")
    got = {(r.hash, r.barcode) for r in dedup.groups(h, lang, n).collect()}
    assert got == {("1", "a"), ("1", "b")}
    others = {r.barcode: r.likely_duplicates for r in dedup.likely_duplicates(h, dedup.groups(h, lang, n)).collect()}
    assert others["c"] == ["a", "b"] and others["a"] == ["b"] and others["d"] is None and others["i"] is None


@pytest.mark.parametrize(
    ("texts", "kinds", "want"),
    [
        (["inter-", "national law. Fine", "Next one"], ["PARAGRAPH_CHUNK"] * 3, "international law. Fine \n\nNext one"),
        (["A TITLE", "GOES ON", "Text here."], ["HEADING_OR_TITLE", "HEADING_OR_TITLE", "PARAGRAPH_END"], "A TITLE GOES ON \n\nText here."),
        (["12", "text"], ["PAGE_NUMBER", "UNKNOWN"], "12 text"),
        (["***", "x"], ["NOISE_OR_BROKEN_TEXT", "UNKNOWN"], O.cleaned("\n\n---\n\nx ")),
        (["Alpha.", "-", "Beta"], ["UNKNOWN", "NOISE_OR_BROKEN_TEXT", "UNKNOWN"], "Alpha. \n\nBeta"),
        (["1 item first", "Another one"], ["LOOSE_SENTENCE_OR_LIST_ITEM", "UNKNOWN"], "1 item first\n\nAnother one"),
    ],
)
def test_recomposition(texts, kinds, want):
    assert O.recompose(1, texts, kinds)[0] == want


def test_heads_go_from_late_pages_only():
    head = ["RUNNING_HEAD"]
    assert O.recompose(9, ["A head"], head) == ("A head", ["UNKNOWN"]) and O.recompose(10, ["A head"], head) == ("", head)
    pages = ["My running head here\n\ntext"] * 12
    out = O.without_heads(pages)
    assert out[9] == pages[9] and out[10] == "text"
    assert O.without_heads(["a b c\n\nx"] * 3 + ["y"] * 9) == ["a b c\n\nx"] * 3 + ["y"] * 9


@pytest.mark.parametrize(("text", "want"), [("- 12 - text", "text"), ("-12 text", "text"), ("12 text", "text"), ("text 12", "text 12"), ("long before 12 text", "long before 12 text")])
def test_page_numbers(text, want):
    assert O.without_page_number(text) == want
    assert O.finish(["x"] * 10 + [text])[10] == want and O.finish([text])[0] == text


def test_digit_hyphens():
    assert O.finish(["12- 34 and a-12- 34"])[0] == "1234 and a-12- 34"


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="ab A1.-—,*\n", max_size=8), st.sampled_from(O.LINE_TYPES)), max_size=6))
def test_recomposition_never_fails(lines):
    out, kinds = O.recompose(12, [t for t, _ in lines], [k for _, k in lines])
    assert out == out.strip() and len(kinds) == len(lines) and "PAGE_NUMBER" not in [k for k, (t, _) in zip(kinds, lines) if t.strip()]


def test_postprocess_keeps_pages_and_counts_types(spark):
    books = spark.createDataFrame([("b", ["One line.\nAnother", "2", ""])], "barcode string, text_by_page array<string>")
    r = O.postprocess(O.classified(O.lines(books))).first()
    assert len(r.text_by_page) == 3 and sum(r.stats.values()) == 4


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab .,\n", max_size=80), st.integers(3, 20))
def test_splitter(text, size):
    out = T.split_text(text, size)
    assert all(0 < len(c) <= size for c in out) and "".join("".join(out).split()) == "".join(text.split())


def test_simhash_is_close_for_close_texts():
    r = random.Random(1)
    a = "".join(r.choice("abcdefgh") for _ in range(400))
    distance = lambda x, y: bin(simhash(x) ^ simhash(y)).count("1")
    assert distance(a, a + "!!! ") == 0 and distance(a, a[:-3] + "zzz") < 8 < distance(a, a[::-1])
    assert 0 <= simhash("ab") < 1 << 64


def test_histogram_edges(spark):
    assert stats.edges(100, 33047) == [0, 100, 100, 200, 300, 500, 700, 1000, 1000, 2000, 3000, 5000, 7000, 10000, 20000, 20000, 30000]
    d = spark.createDataFrame([(0,), (99,), (100,), (33047,)], "n long")
    assert sum(r.n for r in stats.histogram(d, "n", 100).collect()) == 3


def test_years_and_thresholds(spark):
    y = spark.createDataFrame([(None,), (2024,), (2025,), (2026,)], "year int")
    assert {r.caption: r.value for r in stats.years(y).collect()} == {"known": 1, "unknown": 1}
    d = spark.createDataFrame([("b", "eng", 1000, 50.0), ("b", "fra", 999, 49.0), ("c", "eng", 2000, 60.0), ("c", "deu", 3000, 40.0)], "barcode string, iso639_3 string, token_count long, percentage_of_total double")
    got = {r.barcode: [x.language for x in r.language_distribution] for r in language.distribution(d, 1000).collect()}
    assert got == {"b": ["eng"], "c": ["deu", "eng"]}


def test_guards_and_upserts(spark):
    b = spark.createDataFrame([("a",), ("b",)], "barcode string")
    with pytest.raises(ValueError):
        incremental.require({"t": b.limit(1)}, b)
    incremental.require({"t": b}, b, present={"t": (b, "barcode")})
    assert incremental.missing(b, b.limit(0)).count() == 2 and incremental.missing(b, None).count() == 2


def test_topic_sets_are_stable(spark):
    d = spark.createDataFrame([(f"b{i}", "Music" if i % 2 else "Law, Music") for i in range(60)], "barcode string, from_metadata string")
    dictionary = spark.createDataFrame([("Music", "MUSIC")], "topic string, target_topic string")
    one, two = (sorted(topics.training_set(x, dictionary, benchmark=5, test=10, least=1).collect()) for x in (d, d.repartition(5)))
    assert one == two and [sum(r.set == s for r in one) for s in ("benchmark", "test", "train")] == [5, 10, 15]
    with pytest.raises(ValueError):
        topics.training_set(d, dictionary, least=1000)


def test_sources(spark, tmp_path):
    (tmp_path / "b1_ocr.jsonl").write_text('"page \\u00e9 one\\nline"\n\n"two"\n')
    r = sources.pages(spark, str(tmp_path / "*.jsonl")).first()
    assert (r.barcode, r.text_by_page) == ("b1", ["page é one\nline", "two"])
    (tmp_path / "c.csv").write_text('Barcode,MARC Date 1\nb1,"18,50"\n')
    assert sources.catalogue(spark, str(tmp_path / "c.csv")).first().asDict() == {"barcode": "b1", "marc_date_1": "18,50"}
    with tarfile.open(tmp_path / "v1.tar", "w") as tar:
        for name, data in (("1.tif", b"i"), ("1.html", b"<p>"), ("1.txt", b"t"), ("m.xml", b"<m/>"), ("c.md5", b"aa  1.tif\nbb  1.html\ncc  1.txt\ndd  m.xml\n")):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    v = sources.archives(spark, str(tmp_path / "v1.tar")).first()
    assert (v.barcode, v.text, v.gxml, len(v.md5)) == ("v1", ["t"], "<m/>", 4)


def test_sinks(spark, tmp_path):
    d = spark.range(250).select(F.col("id").cast("string").alias("barcode"))
    sources.write_records(d.coalesce(1), str(tmp_path / "r"))
    assert len(list((tmp_path / "r").glob("train-*.parquet"))) == 3
    sources.write_sheet(d, str(tmp_path / "s"))
    assert spark.read.csv(str(tmp_path / "s"), header=True).count() == 250


def test_integrity(spark):
    a = spark.createDataFrame([("1", 1, [1]), ("2", 2, None)], "barcode_src string, x int, y array<int>")
    b = spark.createDataFrame([("1", 1, [2]), ("3", 2, None)], "barcode_src string, x int, y array<int>")
    assert {r.column: r.different for r in publish.integrity(a, b).collect()} == {"x": 0, "y": 1, "(only published)": 1, "(only computed)": 1}


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    schema = "barcode string, count_from_ocr int"
    at, count = str(tmp_path / "t"), lambda d: d.select("barcode", F.size(F.split("text", "\n")).alias("count_from_ocr"))
    for k, rows in enumerate([[("a", "x"), ("b", "x\ny")], [("a", "x\ny\nz")], [("a", "x\ny")]]):
        (tmp_path / "in" / f"{k}.json").write_text("\n".join(json.dumps({"barcode": b, "text": t}) for b, t in rows))
        streaming.maintain(streaming.page_stream(spark, str(tmp_path / "in")), count, at, str(tmp_path / "c")).awaitTermination()
        want = [{("a", 1), ("b", 2)}, {("a", 3), ("b", 2)}, {("a", 2), ("b", 2)}][k]
        assert {tuple(r) for r in streaming.current(spark, at, schema).collect()} == want
    streaming.compact(spark, at, schema)
    assert {tuple(r) for r in streaming.current(spark, at, schema).collect()} == want and [p.name for p in (tmp_path / "t").glob("batch=*")] == ["batch=2"]


def test_windowed_counts_as_a_stream(spark, tmp_path):
    rows = [("2024-01-01 00:10:00", "view"), ("2024-01-01 00:50:00", "view"), ("2024-01-01 01:10:00", "click")]
    events = spark.createDataFrame(rows, "ts string, event_type string").withColumn("ts", F.col("ts").cast("timestamp"))
    events.write.parquet(str(tmp_path / "in"))
    stream = streaming.windowed_counts(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.outputMode("complete").format("memory").queryName("windowed").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r.window.start.hour, r.event_type, r["count"]) for r in spark.table("windowed").collect()) == [(0, "view", 2), (1, "click", 1)]


def test_sessions_without_a_shared_folder_are_refused_on_a_cluster(spark, monkeypatch):
    from bookweave import scratch

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.shared_folder(Session())
    Context.master = "local[4]"
    assert scratch.shared_folder(Session())


def test_topic_sets_must_be_large_enough(spark):
    sets = spark.createDataFrame([("a", "benchmark"), ("b", "test"), ("c", "train")], "barcode string, set string")
    topics.require(sets, benchmark=1, test=1, train=1)
    with pytest.raises(ValueError, match="train"):
        topics.require(sets, benchmark=1, test=1, train=2)


def test_duplicate_classes_are_linear(spark):
    h = spark.createDataFrame([(f"b{i:02}", "1") for i in range(9)] + [("x", "2")], "barcode string, hash string")
    got = dedup.classes(h, h.filter("hash = '1'")).collect()
    assert len(got) == 9 and {(r.representative, r.members) for r in got} == {("b00", 9)}


def test_fingerprints_are_worked_out_side_by_side(monkeypatch):
    """No call per shingle, the same values: texts longer than a piece, many scripts, short and blank ones."""
    from bookweave.functions import simhash as S

    odd = ["", " ", None, "!!!", "abc", "abcdefg", "a" * 700, "ß Straße ÄÖÜ 你好世界你好世界 😀 x𝔘𝔫𝔦𝔠𝔬𝔡𝔢", "привет мир как дела", "Ünïcödé " * 99, "İstanbul ΣΑΣ test", "".join(chr(0x4E00 + i) for i in range(600))] * 2
    want = [None if t is None or not t.strip() else str(S.simhash(t)) for t in odd]
    monkeypatch.setattr(S, "_hashes", [])
    assert S.simhashes(odd) == want
    monkeypatch.setattr(S, "HELD", 10)
    assert S.simhashes(odd) == want
    monkeypatch.setattr(S, "simhash", None)
    assert S.simhashes([odd[9], odd[6]]) == [want[9], want[6]]


def test_counts_make_no_ngrams(spark):
    """How many n-grams a text has follows from its words; only different ones are made."""
    from bookweave.functions import text as T

    m = T.metrics(spark.createDataFrame([("a", "One two,\nthree​ four—five. Six?"), ("b", " \n"), ("c", "x")], "barcode string, text string"))
    plan = m.select("barcode", "bigram_count", "trigram_count")._jdf.queryExecution().optimizedPlan().toString()
    assert "concat_ws" not in plan and "concat_ws" in m._jdf.queryExecution().optimizedPlan().toString()
    assert "translate" not in m._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in m.select("bigram_count", "trigram_count", "char_count_continuous").collect()] == [(9, 8, 25), (None, None, 0), (None, None, 1)]


def test_the_sheet_makes_fingerprints_once(spark, sf_dir, monkeypatch):
    from bookweave.plans import queries as Q

    made, make = [], Q.S.fingerprints
    monkeypatch.setattr(Q.S, "fingerprints", lambda books: made.append(1) or make(books))
    Q._sheet_tables(spark, sf_dir)
    assert len(made) == 1


def test_means_are_rounded_as_in_sql(spark):
    """A mean over 640 sentences may end in a tie that is one in decimals and none in doubles."""
    import duckdb
    from bookweave.plans import queries as Q

    pairs = [(float(a), float(n)) for n in (3, 128, 640, 1280, 1920) for a in range(n, n + 700)] + [(-641.0, 640.0), (0.0, 1.0), (1e300, 1.0), (float("inf"), 1.0)]
    got = Q.rounded(spark.createDataFrame([(a / n,) for a, n in pairs] + [(None,)], "x double").coalesce(1)).collect()
    want = duckdb.connect().execute("SELECT round(unnest(?::DOUBLE[]), 6)", [[a / n for a, n in pairs] + [None]]).fetchall()
    assert [r.x for r in got] == [x for x, in want]
    assert got[pairs.index((641.0, 640.0))].x == 1.001562


def test_chunks_are_sent_by_bounded_pieces():
    """A batch of long texts is not held as one frame of all its chunks."""
    import pandas as pd
    from bookweave.functions import text as T

    class Books:
        def select(self, *_):
            return self

        def mapInPandas(self, cut, _):
            return list(cut(iter([pd.DataFrame({"barcode": list("abcdef"), "text": ["word " * 120_000] * 4 + [None, "a last one here"]})])))

    frames = T.chunks(Books())
    assert len(frames) == 3 and max(f.chunk.str.len().sum() for f in frames) < 2 * T.HELD
    whole = pd.concat(frames)
    assert whole.groupby("barcode").chunk.count().to_dict() == {k: len(T.split_text("word " * 120_000, 768)) for k in "abcd"} | {"f": 1}
