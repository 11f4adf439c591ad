"""Queries that SQL cannot express, against plain Python over the same books."""

import collections
import math
import re

import pytest

from bookweave import fixtures as X
from bookweave.functions.text import split_text
from bookweave.operators import language as L
from bookweave.operators import metadata as M
from bookweave.operators import ocr as O
from bookweave.plans.queries import QUERIES

TOKEN = re.compile(r"[^\W]+|[^\w\s]")


@pytest.fixture(scope="module")
def books(spark, sf_dir):
    return {r.barcode: r.text for r in X.books(spark, sf_dir).collect()}


def detect(chunk):
    found = [w for w in re.split(r"[\W\d_]+", chunk.lower())]
    hits = {code: sum(w in own.split() for w in found) for code, own in L.FREQUENT.items()}
    best = min(hits, key=lambda c: (-hits[c], c))
    return best if hits[best] else "und"


def tokens(text):
    return sum(math.ceil(len(w) / 4) for w in TOKEN.findall(text))


@pytest.fixture(scope="module")
def detected(books):
    out = {}
    for b, t in books.items():
        by = collections.Counter()
        for c in split_text(t, 768):
            if len(c) >= 10:
                by[detect(c)] += tokens(c)
        out[b] = by
    return out


def test_language_detection(spark, sf_dir, detected):
    got = {(r.barcode, r.iso639_3): (r.token_count, r.percentage_of_total) for r in QUERIES["language_detection"](spark, sf_dir).collect()}
    want = {(b, k): (n, round(n / sum(by.values()) * 100, 6)) for b, by in detected.items() for k, n in by.items()}
    assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-5 for k in want)


def test_language_main_and_distribution(spark, sf_dir, detected):
    main = {b: max(by, key=lambda k: (by[k], k)) for b, by in detected.items() if by}
    got = {r.barcode: r.from_detection_iso639_3 for r in QUERIES["language_main"](spark, sf_dir).collect()}
    assert got == {b: None if k == "und" else k for b, k in main.items()}
    got = {r.barcode: [(x.language, round(x.proportion, 6)) for x in r.language_distribution] for r in QUERIES["language_distribution"](spark, sf_dir).collect()}
    want = {b: [(k, round(n / sum(by.values()) * 100, 6)) for k, n in sorted(by.items(), key=lambda x: (-x[1], x[0])) if n >= 1000] for b, by in detected.items()}
    assert got == {b: v for b, v in want.items() if v}


def test_ocr_quality_detection(spark, sf_dir, books):
    want = {}
    for b, t in books.items():
        if parts := split_text(t, 120):
            want[b] = math.floor(sum(detect(c) != "und" for c in parts) / len(parts) * 100)
    assert {r.barcode: r.from_detection for r in QUERIES["ocr_quality_detection"](spark, sf_dir).collect()} == want


@pytest.fixture(scope="module")
def processed(spark, sf_dir):
    """Each book folded page by page on the driver, from lines that are sorted here."""
    rows = O.classified(O.lines(X.pages(spark, sf_dir))).collect()
    by = collections.defaultdict(lambda: collections.defaultdict(list))
    for r in rows:
        by[r.barcode][r.page_number].append((r.line_number, r.text, r.target_type))
    out = {}
    for b, pages in by.items():
        done = [O.recompose(p, [x[1] for x in sorted(own)], [x[2] for x in sorted(own)]) for p, own in sorted(pages.items())]
        out[b] = (O.finish([t for t, _ in done]), collections.Counter(k for _, kinds in done for k in kinds))
    return out


def test_recomposed_books_and_line_types(spark, sf_dir, processed):
    got = {r.barcode: (r.text, r.pages) for r in QUERIES["ocr_recomposed"](spark, sf_dir).collect()}
    assert got == {b: ("\f".join(p), len(p)) for b, (p, _) in processed.items()}
    types = sum((c for _, c in processed.values()), collections.Counter())
    assert {r.caption: r.value for r in QUERIES["ocr_postprocessed_stats"](spark, sf_dir).collect()} == dict(types)


def means(rows, key):
    by = collections.defaultdict(list)
    for r in rows:
        if r[key] is not None:
            by[r[key]].append(r)
    avg = lambda own, c: (lambda v: sum(v) / len(v) if v else None)([r[c] for r in own if r[c] is not None])
    return {k: lambda c, own=own: avg(own, c) for k, own in by.items()}


@pytest.mark.parametrize(("name", "key"), [("src_vs_gen_by_language", "language"), ("src_vs_gen_by_decade", "decade")])
def test_comparisons(spark, sf_dir, books, processed, name, key):
    def counts(t):
        w = re.findall(r"[^\W]+|[^\w\s]", t.lower().replace("\n", "").replace("​", ""))
        return {"word_count": len(w) or None, "bigram_count": max(len(w) - 1, 0) or None}

    c = X.catalogue(spark, sf_dir)
    if key == "language":
        group = {r.barcode: r.from_metadata_iso639_3 for r in M.main_language(c, X.languages(spark)).collect()}
    else:
        group = {r.barcode: r.decade for r in M.year(c).collect()}
    rows = [{key: group[b], **{f"{k}_src": v for k, v in counts(t).items()}, **{f"{k}_gen": v for k, v in counts("\n".join(processed[b][0])).items()}} for b, t in books.items()]
    want = means(rows, key)
    got = QUERIES[name](spark, sf_dir).collect()
    assert {r[key] for r in got} == set(want)
    for r in got:
        for col in ("word_count_src", "word_count_gen", "bigram_count_src", "bigram_count_gen"):
            assert r[col] == pytest.approx(want[r[key]](col), abs=1e-5), (r[key], col)
