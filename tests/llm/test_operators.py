"""The operators against brute force, and on nulls, empty and very long texts, ties, repeated rows, empty tables and
extra columns whose names clash with what the operators use inside."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from bookweave.llm import op01_quality_rules as op1
from bookweave.llm import op02_sentencepiece as op2
from bookweave.llm import op03_quality_crf as op3
from bookweave.llm import op04_mixing as op4
from bookweave.llm import op05_substring_dedup as op5
from bookweave.llm import op06_url_filter as op6
from bookweave.llm import op07_html_extraction as op7
from bookweave.llm import op08_exact_topk as op8
from bookweave.llm import op09_token_records as op9
from bookweave.llm import op10_jaccard_join as op10
from bookweave.llm.automaton import SuffixAutomaton
from bookweave.llm.common import Scratch
from bookweave.llm.components import components

R = random.Random(5)
SOME = ["alpha", "beta", "gamma", "delta", "the", "of", "and", "x"]


def text(n, r=R):
    return " ".join(r.choice(SOME) + str(r.randrange(40)) for _ in range(n))


BASE = text(120)
LONG = text(30_000)
ROWS = [
    (1, BASE, "en", "b", 1),
    (2, BASE, "en", "b", 1),
    (3, BASE + " one more", "en", "a", 1),
    (4, BASE.replace("alpha1 ", "ALPHA1 ", 1), None, None, None),
    (5, None, "en", "a", 0),
    (6, "", "en", None, 0),
    (7, " \n\t ", "fr", "a", 3),
    (8, "one", "fr", "c", 3),
    (9, "one two", "fr", "c", 3),
    (10, LONG, "de", "c", 3),
    (11, "a b c d e " * 30, "de", "a", 3),
    (12, "mañana ▁ 你好 \x0b\x0c\x1c q r", "es", "a", 3),
    (13, text(40) + " " + BASE, "en", "a", 3),
    (13, text(40) + " " + BASE, "en", "a", 3),
    (None, "no id at all, no id at all", "en", "a", 3),
    (9_007_199_254_740_993, text(60), "en", "a", 3),
]
EXTRA = ["size", "h", "_id", "_copies", "source_size", "target", "doc", "kind", "piece", "pack", "value", "gone", "node", "cell", "label", "rep", "keep", "score", "w", "known"]


@pytest.fixture(scope="module")
def docs(spark):
    d = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    return d.select("*", *(F.lit(c).alias(c) for c in EXTRA)).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (11, 0, 0), (11, 0, 0), (12, None, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")


def words(t):
    return (t or "").encode().split()


def by_id(rows):
    return sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0))


# --- 1


def expected_counts(t):
    w = words(t)
    grams = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    return (len(w), sum(len(x.decode()) for x in w), sum(c in op1.SYMBOLS for c in t or ""), dup, len(covered))


def test_quality_counts(docs):
    got = collections.Counter((r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in op1.counts(docs).collect())
    assert got == collections.Counter((r[0], expected_counts(r[1])) for r in ROWS)


def test_quality_rules_learn_thresholds(spark):
    r = random.Random(1)
    rows = [(i, text(50, r) if i % 3 else " ".join("$" + w[1:] for w in text(50, r).split()), i % 3) for i in range(600)]
    d = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    known = spark.createDataFrame([(i, int(k > 0)) for i, _, k in rows[:400]], "doc_id long, quality int")
    got = op1.judge(spark, d, known).collect()
    assert all(x.kept == (x.doc_id % 3 > 0) for x in got)
    assert any("symbols_per_word >" in (x.rule or "") for x in got)


def test_quality_rules_edges(spark, docs, empty, labels):
    got = op1.judge(spark, docs, labels).collect()
    assert len(got) == len(ROWS) and all(r.base_failed and not r.kept for r in got if r.n_words < 10)
    assert op1.judge(spark, empty, labels).count() == 0
    assert op1.judge(spark, docs, labels.limit(0)).filter("not base_failed and not kept").count() == 0


# --- 2


@pytest.fixture(scope="module")
def vocabulary():
    return op2.Vocabulary(op2.model())


def segmentations(v, c):
    if not c:
        return [(0.0, ())]
    out = []
    for j in range(1, len(c) + 1):
        found = v.pieces.get(c[:j])
        edge = (found[1], (found[0],)) if found else (v.unknown, tuple(v.bytes[b] for b in c[0].encode())) if j == 1 else None
        if edge:
            out += [(edge[0] + s, (edge[1], *ids)) for s, ids in segmentations(v, c[j:])]
    return out


def test_nbest_is_exact(vocabulary):
    r = random.Random(2)
    for _ in range(80):
        c = op2.MARK * r.randint(0, 2) + "".join(r.choice("thean√éo") for _ in range(r.randint(1, 7)))
        every = sorted(segmentations(vocabulary, c), key=lambda x: (-x[0], x[1][::-1]))
        flat = [(s, tuple(i for ids in e for i in ids)) for s, e in every]
        assert vocabulary.nbest(c, 6) == flat[:6]
        score, gap, ids = vocabulary.best(c)
        assert (score, tuple(ids)) == flat[0] and gap == (flat[0][0] - flat[1][0] if len(flat) > 1 else float("inf"))


def test_documents_have_the_lattices_nbest(vocabulary):
    r, s = random.Random(3), op2.Segmenter(op2.model())
    for _ in range(80):
        t = "x" + " ".join("".join(r.choice("thean\n") for _ in range(r.randint(0, 4))) for _ in range(r.randint(1, 4)))
        whole, got = vocabulary.nbest(op2.MARK + t.replace(" ", op2.MARK), 4), s(t, 4)
        assert [x for x, _ in whole] == [x for x, _ in got]
        assert tuple(got[0][1].tolist()) == whole[0][1] and len({tuple(i.tolist()) for _, i in got}) == len(got)


def test_sentencepiece_edges(spark, docs, empty):
    got = op2.segment(spark, docs, path=op2.model()).collect()
    assert all(r.round_trip for r in got) and len(got) == len(ROWS)
    assert all(len(r.segmentations) == 1 for r in got if r.doc_id in (5, 6))
    out = op2.encode(spark, docs, path=op2.model())
    assert set(EXTRA) <= set(out.columns) and out.count() == len(ROWS)
    assert op2.encode(spark, empty, path=op2.model()).count() == 0


# --- 3


def test_crf_marginals_are_those_of_all_labellings():
    r = np.random.default_rng(1)
    crf = op3.Crf([np.array([0.0])])
    crf.pair = r.normal(size=(2, 2))
    p, n = r.normal(size=(3, 4)), np.array([4, 2, 1])
    good, _, total = crf.marginals(p, n)
    for d in range(3):
        z, want = 0.0, np.zeros(n[d])
        for bits in np.ndindex(*(2,) * n[d]):
            w = np.exp(sum(p[d, t] * b for t, b in enumerate(bits)) + sum(crf.pair[a, b] for a, b in zip(bits, bits[1:])))
            z, want = z + w, want + w * np.array(bits)
        assert np.allclose(good[d, : n[d]], want / z) and np.isclose(total[d], np.log(z))


def test_classifier_separates_held_out(spark, sf_dir):
    got = op3.query(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.85
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def test_classifier_edges(spark, docs, empty, labels):
    crf = op3.train(docs, labels)
    got = op3.score(spark, docs, crf).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (5, 6)}) == 1
    assert {r.score for r in op3.score(spark, docs, op3.train(docs, labels.limit(0))).collect()} == {0.5}
    assert op3.keep(spark, docs, labels).columns == docs.columns and op3.keep(spark, empty, labels).count() == 0
    assert {r.doc_id for r in op3.score(spark, docs, crf).collect()} == {r[0] for r in ROWS}


# --- 4


def shares(sizes, weights=(1, 2, 3), most=3.0):
    """Share and reshare until nothing is above its cap."""
    w, cap = [weights[i % 3] for i in range(len(sizes))], [most * s for s in sizes]
    t, free = [sum(sizes) * x / sum(w) for x in w], set(range(len(sizes)))
    while over := [i for i in free if t[i] > cap[i] + 1e-9]:
        excess = sum(t[i] - cap[i] for i in over)
        free -= set(over)
        for i in over:
            t[i] = cap[i]
        for i in free:
            t[i] += excess * w[i] / sum(w[j] for j in free)
    return t


@pytest.mark.parametrize("sizes", [[100, 10, 1000, 5, 70], [1, 1, 1000], [0, 5, 5, 9000, 20, 1], [7]])
def test_targets_reshare_the_excess(spark, sizes):
    d = spark.createDataFrame([(f"s{i}", s) for i, s in enumerate(sizes)], "source string, source_size long")
    got = [r.target for r in op4.targets(d, (1, 2, 3), 3.0).orderBy("source").collect()]
    assert np.allclose(got, shares(sizes))


def test_mixing_takes_near_its_targets(spark):
    rows = [(i, "w " * (1 + i % 7), f"s{i % 4}" if i % 3 else "s0") for i in range(4000)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = op4.plan(spark, d).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.source].append(r)
        assert r.taken == r.copies * r.size <= 3 * r.size
    assert all(abs(sum(r.taken for r in v) - v[0].target) <= 7 for v in by.values())
    assert sorted(got) == sorted(op4.plan(spark, d.repartition(7)).collect())
    assert op4.apply(spark, d).count() == sum(r.copies for r in got)


def test_mixing_edges(spark, docs, empty):
    got = op4.plan(spark, docs).collect()
    assert len(got) == len(ROWS) and all(r.size == len(words(dict((x[0], x[1]) for x in ROWS)[r.doc_id])) for r in got)
    assert op4.apply(spark, docs).columns == docs.columns
    assert op4.plan(spark, empty).count() == 0 and op4.apply(spark, empty).count() == 0


# --- 5


def kept_words(rows, window=20):
    seen, out = {}, []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        w = words(t)
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - window + 1):
            if seen.setdefault(tuple(w[k : k + window]), (i, k)) < (i, k) if i is not None else tuple(w[k : k + window]) in seen:
                gone[k : k + window] = True
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), int(gone.sum()), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def test_substrings_are_those_of_brute_force(spark):
    r = random.Random(4)
    shared = [text(r.randint(15, 60), r) for _ in range(12)]
    rows = [(i, " ".join(r.choice([text(r.randint(0, 30), r), r.choice(shared), "z " * r.randint(0, 50)]) for _ in range(r.randint(0, 6)))) for i in range(150)]
    got = op5.digest(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert sorted(tuple(x) for x in got) == sorted(kept_words(rows))


def test_substring_edges(spark, docs, empty):
    got = op5.digest(spark, docs).collect()
    want = kept_words([(r[0], r[1]) for r in dict.fromkeys((x[0], x[1]) for x in ROWS)])
    assert {tuple(x) for x in got} == set(want) and len(got) == len(ROWS)
    out = op5.apply(spark, docs)
    assert out.columns == docs.columns and out.count() == len(ROWS)
    assert out.filter("doc_id = 5 and text is null").count() == 1
    assert op5.apply(spark, empty).count() == 0 and op5.digest(spark, empty).count() == 0


def cut_by_row(rows, window=20):
    """A window goes if its words start at a smaller (doc_id, start) in any row; null ids are the largest."""
    first, out = {}, []
    places = [((i is None, i or 0), [tuple(words(t)[k : k + window]) for k in range(len(words(t)) - window + 1)], i, words(t)) for i, t in rows]
    for key, windows, _, _ in places:
        for k, w in enumerate(windows):
            first[w] = min(first.get(w, (key, k)), (key, k))
    for key, windows, i, w in places:
        gone = {j for k, x in enumerate(windows) if first[x] < (key, k) for j in range(k, k + window)}
        kept = [x for j, x in enumerate(w) if j not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def test_substring_rows_are_cut_each_by_itself(spark):
    r = random.Random(11)
    known, new, late = (text(60, r) for _ in range(3))
    rows = [(1, known), (None, text(45, r) + " " + known), (None, text(200, r)), (None, None), (7, new), (7, new), (None, late), (None, late), (None, text(9, r) + " " + late)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(x) for x in op5.digest(spark, d.repartition(3)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, cut_by_row(rows)))
    assert sorted(x[1:3] for x in got if x[0] is None) == [(0, 0), (60, 0), (60, 0), (69, 60), (105, 60), (200, 0)]
    assert sum(x.text == new for x in op5.apply(spark, d).collect()) == 2


@pytest.mark.parametrize("parts", [1, 5])
def test_substrings_with_shared_and_null_ids(spark, parts):
    r = random.Random(12)
    shared = [text(r.randint(18, 60), r) for _ in range(10)]
    made = [" ".join(r.choice([text(r.randint(0, 30), r), r.choice(shared), r.choice(shared), "z " * r.randint(0, 50)]) for _ in range(r.randint(0, 6))) for _ in range(90)]
    rows = [(r.choice([None, None, 3, 3, 4, *range(5, 40)]), r.choice([t, r.choice(made)])) for t in made for _ in range(2)]
    got = op5.digest(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()
    assert sorted(str(tuple(x)) for x in got) == sorted(map(str, cut_by_row(rows)))


@pytest.mark.parametrize("hot", [0, 1])
def test_repeats_within_a_batch_go_as_runs(hot):
    """A long passage in every document: one run a document, in no more rows than pieces; not one of each anchor or window."""
    import numpy as np
    import pandas as pd

    r, pieces = random.Random(13), 4
    passage = text(400, r)
    for n in (60, 120):
        texts = [" ".join([*(f"a{i}-{k}" for k in range(30)), passage, *(f"z{i}-{k}" for k in range(30))]) for i in range(n)]
        at = [np.arange(460) * 2 + hot] * n
        sent = pd.concat(op5._segmented(20, pieces)(iter([pd.DataFrame({"row": range(n), "doc": range(n), "text": texts, "at": at})])))
        assert len(sent) <= 2 * pieces
        known = op5._heard(sent)
        assert sorted(known["row"]) == list(range(1, n))
        # segments that reach beyond the passage differ; they are left to their shards
        spans = [(v >> 32, v & 0xFFFFFFFF) for v in known["value"].tolist()]
        assert all(30 <= a <= 42 and 398 <= z <= 410 for a, z in spans) and (not hot or set(spans) == {(30, 410)})


def test_runs_are_the_union_of_spans():
    import numpy as np

    r = random.Random(14)
    for _ in range(50):
        found = [(r.randint(-2, 2), a, a + r.randint(0, 9)) for a in (r.randint(0, 60) for _ in range(r.randint(0, 25)))]
        row, span = op5._runs(*np.array(found, "i8").reshape(-1, 3).T)
        got = [(k, i) for k, v in zip(row.tolist(), span.tolist(), strict=True) for i in range(v >> 32, (v & 0xFFFFFFFF) + 1)]
        assert sorted(got) == sorted({(k, i) for k, a, z in found for i in range(a, z + 1)})
        assert not any((k, (v & 0xFFFFFFFF) + 1) in got for k, v in zip(row.tolist(), span.tolist(), strict=True))


def test_automaton_statistics():
    r = random.Random(6)
    for _ in range(60):
        parts = [[r.randrange(3) for _ in range(r.randint(1, 12))] for _ in range(r.randint(1, 4))]
        a = SuffixAutomaton()
        for p in parts:
            a.add(p)
        runs = {tuple(p[i:j]) for p in parts for i in range(len(p)) for j in range(i + 1, len(p) + 1)}
        q = [r.randrange(3) for _ in range(15)]
        want = [max([n for n in range(1, i + 2) if tuple(q[i + 1 - n : i + 1]) in runs], default=0) for i in range(len(q))]
        assert a.statistics(q) == want


# --- 6


def test_url_rules_and_edges(spark):
    rows = [(1, "https://a.Example.COM/en/7x?q", None), (2, "http://x.com/en/1", ""), (3, "http://x.net/de/", "<a href='http://bad.org/x'>"), (4, "http://example.net/de/8", "x"), (5, "http://xcom/en/1", "x"), (6, None, None), (7, "no scheme", "x"), (8, "http://y.org/es/", "x"), (8, "http://y.org/es/", "x"), (9, "http://y.org#/es/", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").select("*", F.lit(1).alias("host"), F.lit(2).alias("verdict"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in op6.judge(spark, pages).collect()}
    assert got[1] == ("a.example.com", "/en/7x", "example.com/en/7", "allow")
    assert got[2][2:] == ("com/en/", "block") and got[3][2:] == ("net/de/", "allow") and got[4][2:] == ("example.net/de/8", "block")
    assert got[5][2] is None and got[6][:3] == ("", "", None) and got[7][:3] == ("", "", None)
    assert got[8][2:] == ("org/es/", "block") and got[9][:3] == ("y.org", "", None)
    assert op6.judge(spark, pages.limit(0)).count() == 0


def test_distrust_runs_against_the_links(spark):
    seeds = spark.createDataFrame([("good", 1.0, 0.0), ("bad", 0.0, 1.0), ("farm", 0.0, 0.0), ("fan", 0.0, 0.0)], "host string, seed_trust double, seed_distrust double")
    links = spark.createDataFrame([("farm", "bad", 3.0), ("good", "fan", 1.0)], "src string, dst string, n double")
    got = {r.host: r for r in op6.propagate(Scratch(spark, "t"), seeds, links).collect()}
    assert got["farm"].distrust > 0.5 and got["fan"].trust > 0.5 and got["fan"].distrust == 0 and got["farm"].trust == 0


def test_linked_hosts_are_judged_whatever_the_number_of_links(spark):
    """Ten linkers to one blocked host; a host of which rules block nine pages in ten, linked to; one stray link of many."""
    link = lambda *hosts: "".join(f"<a href='http://{h}/'>" for h in hosts)
    rows = [("bad.com", "/en/1", None), *((f"fan{i}.io", "/", link("bad.com")) for i in range(10))]
    rows += [("mostly.com", f"/en/{i}", None) for i in range(9)] + [("mostly.com", "/x", link("plain0.io")), ("once.io", "/", link("mostly.com"))]
    rows += [("stray.io", "/", link("bad.com", *(f"plain{i}.io" for i in range(20))))] + [(f"far{i}.io", "/", link(f"far{i - 1}.io" if i else "fan0.io")) for i in range(8)]
    rows += [("x.net", "/de/", link("known.io")), ("known.io", "/", link("bad.com"))]
    pages = spark.createDataFrame([(i, f"http://{h}{p}", t) for i, (h, p, t) in enumerate(rows)], "page_id long, url string, html string")
    got = {(r.host, r.path): r for r in op6.judge(spark, pages).collect()}
    assert all(got[f"fan{i}.io", "/"].verdict == "block" and abs(got[f"fan{i}.io", "/"].distrust - 0.85) < 1e-9 for i in range(10))
    assert got["mostly.com", "/x"].verdict == "block" and got["mostly.com", "/x"].distrust == 0.9 and got["once.io", "/"].verdict == "block"
    assert got["stray.io", "/"].verdict == "allow" and got["known.io", "/"].verdict == "allow"
    assert all(abs(got[f"far{i}.io", "/"].distrust - 0.85 ** (i + 2)) < op6.TOLERANCE for i in range(8))


# --- 7


def test_extraction_of_generated_layouts():
    layouts, exact = op7.Layouts(99), 0
    for _ in range(60):
        root = op7.parse(layouts.page())
        nodes, x = op7.features(root)
        got = list(op7.blocks(root, op7.decode(nodes, op7.model().log_odds(x))))
        exact += got == list(op7.blocks(root, [n.parent is None or n.marked for n in nodes]))
    assert exact >= 55


def test_extraction_edges(spark):
    deep = "<div>" * 3000 + "<p>x</p>"
    rows = [(1, "u", "<html><body><nav><a href=/>Home</a></nav><article><h1>A &amp; B</h1><p>One<br>two  three<p>Four, with some more words in it.<div class=comments><p>me too</p></div></article><footer>&copy; x</footer>"), (2, None, None), (3, "u", ""), (4, "u", deep), (5, "u", "plain < text"), (5, "u", "plain < text"), (6, "u", "<article><p>a</b></i></p><script>if (a<b) x('</p>')</script><p>b" + "<p>word " * 5000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r.page_id: r.text for r in op7.texts(spark, pages).collect()}
    assert got[1] == "A & B\nOne two three\nFour, with some more words in it." and got[2] == got[3] == ""
    assert got[6].startswith("a\nb\nword") and "if" not in got[6]
    assert op7.texts(spark, pages.limit(0)).count() == 0


def test_formulas_and_fallback_texts_are_judged_like_their_surroundings(spark):
    kept = ["<math><mi>x</mi><mo>=</mo><mn>2</mn></math>", "<svg><text>height in metres</text></svg>", "<object>a drawing of the tower</object>", "<canvas>a plot of heights</canvas>", "<audio>listen to the talk</audio>", "<video>watch the talk</video>", "<noscript>without scripts too</noscript>", "<iframe>see the other page</iframe>"]
    text = "The tower was built in stone, and its height, as given by the builders, follows from "
    rows = [(i, "u", f"<html><body><nav><noscript>menu without scripts</noscript><a href=/>Home</a></nav><article><h1>On towers</h1><p>{text}{x} in every part.<script>if (a<b) x()</script><textarea>typed</textarea></p><p>{text}this, with some more words in it.</p></article></body></html>") for i, x in enumerate(kept)]
    got = {r.page_id: r.text for r in op7.texts(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, x in enumerate(kept):
        words = "".join(x.replace("<", ">").split(">")[::2]).strip()
        assert words in got[i] and "typed" not in got[i] and "if (" not in got[i] and "menu" not in got[i], (x, got[i])


# --- 8


def test_topk_is_brute_force(spark):
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=8).round(2).tolist()) for i in range(700)] + [(700 + i, [0.5] * 8) for i in range(40)]
    rows += [(800, None), (801, []), (802, [float("nan")] * 8), (803, [None] * 8), (804, [1.0, 2.0]), (None, [1.0] * 8), (699, [9.0] * 8)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1))
    ok = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in rows if i is not None and v and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v)]
    want = set()
    for q, x in ok:
        if q % 50 == 0:
            best = sorted((-int(x @ y), i) for i, y in ok if i != q)[:5]
            want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    for block in (2048, 4):
        got = op8.search(spark, d, F.col("vec_id") % 50 == 0, block=block)
        assert {tuple(x) for x in got.collect()} == want
    assert op8.search(spark, d.limit(0), F.col("vec_id") % 50 == 0).count() == 0


# --- 9


def test_frames_find_every_flipped_byte():
    data = op9.frame(b"hello") + op9.frame(b"")
    assert [p for _, p in op9.frames(data)] == [b"hello", b""]
    for i in range(len(data)):
        with pytest.raises(ValueError):
            list(op9.frames(data[:i] + bytes([data[i] ^ 1]) + data[i + 1 :]))
    with pytest.raises(ValueError):
        list(op9.frames(data[:-1]))


ODD = ["It's don't THE'S x'", "Ünïcode ÀÉ, ß ẞ İ Σας ΟΔΟΣ", "a\tb c\x1cd<|startoftext|>e x<|endoftext|>", "12ab,34 ''s 's!", "é ́x ﬁ ½", "...a---b", "Ÿ ÿ× a×b÷", "x" * 200 + " y" * 3, "'ll'LL we'll, WE'LL!", "µ ª º aª", "", "\n \n"]


def test_words_encode_like_whole_texts():
    import public_tokenizers

    e = op9.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert e.by_word
    texts = ODD + [text(200), BASE.upper() + "!!"]
    want = [x.ids for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, e.kind).tolist() for b in e(texts)] == want


def test_records_round_trip(spark, docs, empty, tmp_path):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    out = f"file://{tmp_path}/records"
    op9.write(spark, docs, out, tokenizer=path, shard_bytes=1)
    listed = op9.with_starts(op9.index(spark, out)).orderBy("start").collect()
    e = op9.Encoder(path)
    want = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    ids = [[*np.frombuffer(b, e.kind).tolist(), 1] for b in e([r[1] for r in want])]
    assert [r.doc_id for r in listed] == [r[0] for r in want]
    assert [r.n_tokens for r in listed] == [len(i) for i in ids] and [r.start for r in listed] == np.cumsum([0, *map(len, ids)])[:-1].tolist()
    assert [r.ids_crc32 for r in listed] == [zlib.crc32(np.array(i, "<u4").tobytes()) for i in ids]
    shuffled = op9.read_shuffled(spark, out, op9.index(spark, out), 3).collect()
    assert sorted((str(r.doc_id), r.ids) for r in shuffled) == sorted((str(r[0]), i) for r, i in zip(want, ids))
    op9.write(spark, empty, f"{out}0", tokenizer=path)
    assert op9.index(spark, f"{out}0").count() == 0


# --- 10


def linked_components(rows, n, num, den):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    root = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and (den * len(a & b) >= num * len(a | b) or rows[i][0] == rows[j][0]):
                x, y = root[i], root[j]
                root = [min(x, y) if k in (x, y) else k for k in root]
    first = {}
    for (i, _), k in zip(rows, root):
        first[k] = min(first.get(k, i), i)
    return sorted((i, len(s), first[k]) for (i, _), s, k in zip(rows, sets, root))


def near_copies(seed):
    r, rows = random.Random(seed), []
    for g in range(14):
        w = text(r.choice([4, 11, 14, 22, 40, 90, 260]), r).split()
        for _ in range(r.randint(1, 9)):
            v = list(w)
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                v[r.randrange(len(v))] = f"n{r.randrange(999)}"
            rows.append((len(rows), " ".join(v[: r.choice([len(v), len(v), len(v) - 1])])))
    return rows


@pytest.mark.parametrize(("n", "num", "den", "block"), [(3, 90, 100, 128), (3, 90, 100, 3), (5, 8, 10, 128), (2, 8, 10, 3)])
def test_jaccard_components(spark, monkeypatch, n, num, den, block):
    monkeypatch.setattr(op10, "BLOCK", block)
    rows = near_copies(n + block)
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(tuple(r) for r in op10.classes(spark, d, n=n, num=num, den=den).collect())
    assert got == linked_components(rows, n, num, den)


def test_keys_meet_for_every_linked_pair():
    """Exhaustively over sizes: sets at the threshold share a key."""
    r = np.random.default_rng(2)
    for size in [*range(9, 60), 150, 700, 2500]:
        for num, den in ((90, 100), (8, 10)):
            x = r.integers(0, 1 << 63, size, dtype="u8")
            cut = (den - num) * size // den
            for y in (x[cut:], np.concatenate([x, r.integers(0, 1 << 63, (den - num) * size // num, dtype="u8")])):
                a, b = (np.unique(s) for s in (x, y))
                key, owner = op10.keys([a, b], num, den)
                assert len(a) == len(b) or set(key[owner == 0]) & set(key[owner == 1]), (size, num)


def test_jaccard_edges(spark, docs, empty):
    got = op10.classes(spark, docs, n=3, num=90, den=100).collect()
    assert len(got) == len(ROWS)
    found = collections.defaultdict(set)
    for r in got:
        found[r.doc_id].add((r.n_shingles, r.component_id))
    assert {c for i in (1, 2, 3, 4) for _, c in found[i]} == {1} and found[5] == {(0, 5)} and found[6] == {(0, 6)} and found[8] == {(1, 8)}
    assert all(c is None for _, c in found[None])
    kept = op10.keep_one(spark, docs, n=3, num=90, den=100)
    assert kept.columns == docs.columns
    ids = sorted(str(r.doc_id) for r in kept.select("doc_id").collect())
    assert ids == sorted(map(str, [1, 5, 6, 7, 8, 9, 10, 11, 12, 13, None, 9_007_199_254_740_993]))
    assert op10.classes(spark, empty, n=3, num=90, den=100).count() == 0 and op10.keep_one(spark, empty).count() == 0


def test_every_pair(spark):
    rows = [(i, BASE + f" tail{i}") for i in range(6)]
    _, links = op10.join(spark, spark.createDataFrame(rows, "doc_id long, text string"), n=3, num=90, den=100, every_pair=True)
    assert {tuple(sorted(x)) for x in links.collect()} == {(i, j) for j in range(6) for i in range(j)}


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 260)] + [(300, 301), (301, 300), (7, 7)]
    got = {r.node: r.label for r in components(Scratch(spark, "t"), spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(100, 161)) and all(got[i] == 5 for i in range(200, 260)) and got[301] == 300 and 7 not in got
