"""The methods themselves against brute force: covering, long words, broadcast automata, tree decoding, blocks of points, bounds."""

import itertools
import math
import random
import re
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from bookweave.llm import op01_quality_rules as op1
from bookweave.llm import op02_sentencepiece as op2
from bookweave.llm import op05_substring_dedup as op5
from bookweave.llm import op07_html_extraction as op7
from bookweave.llm import op08_exact_topk as op8
from bookweave.llm import op09_token_records as op9
from bookweave.llm import op10_jaccard_join as op10
from bookweave.llm.common import Scratch, shared_folder

from test_operators import kept_words, linked_components, near_copies, text, words


# --- 1


def covering(rows, names):
    """Sequential covering in plain Python: rows of (features, bad, part)."""
    ok = lambda rule, x: all(x[f] > t if op == ">" else x[f] <= t for f, op, t in rule)
    rules, least = [], max(op1.MIN_COVER, op1.MIN_SHARE * sum(b and p == 2 for _, b, p in rows))
    while True:
        left = [r for r in rows if not any(ok(rule, r[0]) for rule in rules)]
        rule = []
        while True:
            own = [r for r in left if r[2] < 2 and ok(rule, r[0])]
            p0, n0 = sum(b for _, b, _ in own), len(own)
            gains = {}
            for f in names:
                for t in EDGES[f]:
                    for op in ("<=", ">"):
                        hit = [b for x, b, _ in own if (x[f] <= t) == (op == "<=")]
                        if p0 and p0 < n0 and sum(hit) and op1.MIN_COVER <= len(hit) < n0:
                            gains.setdefault((f, op), []).append((sum(hit) * (math.log2(sum(hit) / len(hit)) - math.log2(p0 / n0)), len(hit), t))
            if not gains:
                break
            f, op = max(sorted(gains), key=lambda k: max(gains[k])[0])
            most = max(gains[f, op])[0]
            if most <= 1e-9:
                break
            t = min((n, t) for g, n, t in gains[f, op] if g >= (1 - op1.SLACK) * most)[1]
            low, high = ([x[f] for x, _, _ in own if (x[f] <= t) == s] for s in (True, False))
            rule.append((f, op, (max(low) + min(high)) / 2 if low and high else t))
        if not rule:
            return rules
        best = max((((sum(b for x, b, p in left if p == 2 and ok(rule[: k + 1], x)) + 1) / (sum(p == 2 and ok(rule[: k + 1], x) for x, _, p in left) + 2), -k) for k in range(len(rule))))
        cut = rule[: 1 - best[1]]
        if best[0] < op1.MIN_PRECISION or sum(p == 2 and ok(cut, x) for x, _, p in left) < least:
            return rules
        rules.append(cut)


EDGES: dict[str, list[float]] = {}


@pytest.mark.parametrize("seed", [1, 2])
def test_covering_learns_what_brute_force_learns(spark, seed):
    r, names = random.Random(seed), ["a", "b", "c"]
    rows = []
    for i in range(500):
        x = {n: r.randrange(8) / 4 for n in names}  # few values, so that the quantiles are all of them
        bad = x["a"] > 1.2 and x["b"] <= 1 or x["c"] > 1.6 or r.random() < 0.03
        rows.append((x, int(bad), i % 3))
    d = spark.createDataFrame([(*x.values(), b, p) for x, b, p in rows], "a double, b double, c double, bad long, part long")
    for n in names:  # the thresholds that learn() takes
        cuts = d.agg(F.percentile_approx(n, [k / op1.BINS for k in range(1, op1.BINS)], 10_000)).first()[0]
        worse = d.filter("bad = 1").agg(F.percentile_approx(n, [0.02, 0.1, 0.25, 0.5, 0.75, 0.9, 0.98], 10_000)).first()[0]
        EDGES[n] = sorted({*cuts, *worse})
    found, want = op1.learn(d, names), covering(rows, names)
    assert len(want) >= 2 and found == want


# --- 2


def test_sidetracks_are_the_lattices_nbest():
    v, r = op2.Vocabulary(op2.model()), random.Random(4)
    s = op2.Segmenter(op2.model())
    for _ in range(120):
        c = "".join(r.choice("thean√éo") for _ in range(r.randint(1, 12)))
        whole, got = v.nbest(c, 6), v.sidetracked(c, 6)
        assert got[0] == whole[0] and np.allclose([x for x, _ in got], [x for x, _ in whole], rtol=0, atol=1e-6) and len({i for _, i in got}) == len(got)
        assert np.allclose([x for x, _ in s._parted(c * 3, 4)], [x for x, _ in v.nbest(c * 3, 4)], rtol=0, atol=1e-6)


LONG_WORD = """
import random, resource, sys
from bookweave.llm import op02_sentencepiece as op2
r = random.Random(1)
s = op2.Segmenter(op2.model())
t = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1_000_000))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
got = s(t, 4)
assert len(got) == 4 and all(s.vocabulary.decode(i.tolist()) == t for _, i in got) and got[0][0] >= got[1][0] >= got[3][0]
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)
"""


def test_a_word_of_a_million_letters_takes_bounded_memory():
    out = subprocess.run([sys.executable, "-c", LONG_WORD], capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout) < 400_000  # KB


def test_encode_keeps_columns_of_its_own_names(spark):
    d = spark.createDataFrame([(1, "a b", "x", 5)], "doc_id long, text string, ids string, N_TOKENS int")
    got = op2.encode(spark, d, path=op2.model()).first()
    assert got["ids_"] == "x" and got["N_TOKENS_"] == 5 and got["n_tokens"] == len(got["ids"]) > 0


# --- 4, 5


CLASH = ["mix_id", "mix_copies", "mix_turn", "row_key", "row_spans", "ROW_SPANS_", "row", "gone", "__spans", "__cut", "__copies"]


def test_helper_columns_never_clash(spark):
    import corpus_pipeline

    d = spark.createDataFrame([(i, "w " * 30 + str(i), "s") for i in range(6)], "doc_id long, text string, source string").select("*", *(F.lit(1).alias(c) for c in CLASH))
    for _, stage in corpus_pipeline.STAGES[2:4]:
        out = stage(spark, d, "")
        assert out.columns == d.columns and out.count() == 6


def test_hot_anchors_are_cut_like_all_others(spark, monkeypatch):
    monkeypatch.setattr(op5, "HOT", 1)
    monkeypatch.setattr(op5, "CHUNK", 200)
    r = random.Random(5)
    phrase = text(12, r)  # shorter than a window, with many continuations
    rows = [(i, " ".join([text(r.randint(0, 9), r), phrase, r.choice(["x y z " * 4, text(14, r)]), text(r.randint(0, 9), r)])) for i in range(120)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert sorted(tuple(x) for x in op5.digest(spark, d).collect()) == sorted(kept_words(rows))


@pytest.mark.parametrize("shard", [40, 50_000])
def test_spans_of_a_broadcast_reference_go(spark, monkeypatch, shard):
    monkeypatch.setattr(op5, "SHARD_WORDS", shard)
    r = random.Random(6)
    known = [text(r.randint(10, 60), r) for _ in range(8)]
    rows = [(i, " ".join(r.choice([text(r.randint(0, 20), r), r.choice(known)]) for _ in range(5))) for i in range(40)] + [(90, None), (91, "")]
    windows = {tuple(words(t)[k : k + 20]) for t in known for k in range(len(words(t)) - 19)}
    reference = spark.createDataFrame([(i, t) for i, t in enumerate(known)] + [(9, None)], "item_id long, text string")
    got = {x.doc_id: x.text for x in op5.against(spark, spark.createDataFrame(rows, "doc_id long, text string"), reference).collect()}
    for i, t in rows:
        w = words(t)
        gone = {j for k in range(len(w) - 19) if tuple(w[k : k + 20]) in windows for j in range(k, k + 20)}
        assert words(got[i]) == [x for j, x in enumerate(w) if j not in gone]
    assert got[90] is None
    with pytest.raises(ValueError):
        op5.against(spark, reference, reference, most=10)


# --- 7


def test_decoding_is_the_best_of_all_labellings():
    r = np.random.default_rng(7)
    for _ in range(60):
        nodes = [op7.Node("div", None, "")]
        for i in range(int(r.integers(0, 9))):
            parent = nodes[int(r.integers(0, len(nodes)))]
            nodes.append(op7.Node("p", parent, ""))
            parent.children.append(nodes[-1])
        for i, n in enumerate(nodes):
            n.index, n.chars = i, int(r.integers(0, 900))
        odds = r.normal(size=len(nodes))
        worth = lambda kept: sum((1 + n.chars / 20) * -np.logaddexp(0, -o if k else o) for n, o, k in zip(nodes, odds, kept))  # noqa: B023, E731
        allowed = [k for k in itertools.product((False, True), repeat=len(nodes)) if all(not k[n.index] or n.parent is None or k[n.parent.index] for n in nodes)]
        got = op7.decode(nodes, odds)
        assert tuple(got) in allowed and abs(worth(got) - max(map(worth, allowed))) < 1e-9


class Unnamed(op7.Layouts):
    """Layouts that never say by class or id what an element is: tags, links, places and lengths have to do."""

    def named(self, semantic, tokens, inner, chance=0.5):
        tag = semantic if semantic else "div"
        return f'<{tag} class="x{self.r.randint(1, 99)} qz">{inner}</{tag}>'

    def comments(self):
        return ""  # without a name, reader comments read like the article

    advert = notice = form = social = comments

    def side(self):
        return self.named("aside", "", f"<h3>{self.words(1, 4)}</h3><ul>{self.items()}</ul>")


def test_extraction_of_layouts_without_names():
    layouts, right, wanted, given = Unnamed(5), 0, 0, 0
    for _ in range(60):
        root = op7.parse(layouts.page().replace('class="article', 'class="zz').replace('id="article', 'id="zz'))
        nodes, x = op7.features(root)
        got = op7.decode(nodes, op7.model().log_odds(x))
        for n, k in zip(nodes, got):
            main = n.parent is None or n.marked
            right += n.chars * (main and k)
            wanted += n.chars * main
            given += n.chars * k
    assert right / wanted > 0.9 and right / given > 0.9


# --- 8


def test_candidates_bounds_exclude_on_clustered_vectors():
    r = np.random.default_rng(9)
    centres = r.normal(size=(40, 16)) * 400
    x = np.floor(centres[r.integers(0, 40, 6000)] + r.normal(size=(6000, 16)) * 8)
    rows = np.arange(6000)
    pivots = op8.spread(x[:500], 32)
    dist = op8.distances(x, pivots)
    s = op8.Searcher(rows[:50], x[:50], dist[:50], 5)
    for k in range(0, 6000, 2000):
        s.feed(rows[k : k + 2000], rows[k : k + 2000], x[k : k + 2000], dist[k : k + 2000])
    for q in range(50):
        want = sorted((-int(x[q] @ x[i]), i) for i in range(6000) if i != q)[:5]
        assert [(a, b) for a, b, _ in s.best[q]] == want
    assert s.evaluated < 0.5 * 50 * 6000


# --- 9


def test_shards_grow_and_never_stop_growing_in_number():
    mb, tb = 1 << 20, 1 << 40
    assert op9.shard_count(0) == 2 and op9.shard_count(120 * mb) == 10
    assert op9.shard_count(100 * tb) == 100 * tb // op9.MOST_BYTES and op9.shard_count(1000 * tb) == 10 * op9.shard_count(100 * tb)


# --- 10


def passages(seed, n=90):
    """Unrelated texts that share passages, beside near copies: large cells with few links."""
    r = random.Random(seed)
    shared = [text(30, r) for _ in range(3)]
    rows = [(i, " ".join([text(r.randint(5, 40), r), r.choice(shared), text(r.randint(5, 40), r)])) for i in range(n)]
    return rows + [(1000 + i, t) for i, (_, t) in enumerate(near_copies(seed))]


@pytest.mark.parametrize("every", [False, True])
def test_blocks_of_points_and_of_sets(spark, monkeypatch, every):
    """Cells of several blocks, compared by points and then by sets, one way and in full."""
    monkeypatch.setattr(op10, "BLOCK", 6)
    monkeypatch.setattr(op10, "POINTS", 10)
    monkeypatch.setattr(op10, "_refined", lambda scratch, sets, num, den, parts: sets)
    rows = passages(3)
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    if not every:
        got = sorted(tuple(r) for r in op10.classes(spark, d, n=3, num=60, den=100).collect())
        assert got == linked_components(rows, 3, 60, 100)
        return
    known, links = op10.join(spark, d, n=3, num=60, den=100)
    sets = {i: frozenset(tuple(words(t.lower())[k : k + 3]) for k in range(max(1, len(words(t)) - 2))) for i, t in rows}
    first = {}
    for i in sorted(sets):
        first.setdefault(sets[i], i)
    reps = sorted(first.values())
    want = {(a, b) for a, b in itertools.combinations(reps, 2) if 100 * len(sets[a] & sets[b]) >= 60 * len(sets[a] | sets[b])}
    assert {tuple(sorted(r)) for r in links.collect()} == want
    near = {i: sum(j != i and 100 * len(sets[i] & sets[j]) >= 60 * len(sets[i] | sets[j]) for j in sets) for i in sets}
    assert {r.doc_id: r.n_links for r in op10.degrees(known, links).collect()} == near


def test_refined_cells_keep_all_links(spark, monkeypatch):
    monkeypatch.setattr(op10, "BLOCK", 4)
    rows = passages(4)
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(tuple(r) for r in op10.classes(spark, d, n=5, num=8, den=10).collect()) == linked_components(rows, 5, 8, 10)


def test_only_texts_that_can_link_have_sets(spark, monkeypatch):
    """Texts that share passages alone are told apart before sets are written, and few tables stay on disk."""
    written, write = {}, Scratch.write

    def noted(self, df, name):
        out = write(self, df, name)
        if name in ("chosen", "sets"):
            written[name] = [r.node for r in out.select("node").collect()]
        return out

    monkeypatch.setattr(Scratch, "write", noted)
    monkeypatch.setattr(op10, "BLOCK", 4)
    rows = passages(4)
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    known, _ = op10.join(spark, d, n=5, num=8, den=10)
    assert known.count() == len(rows) and sum(i < 90 for i in written["chosen"]) > 60
    assert written["sets"] and sum(i < 90 for i in written["sets"]) < 10


def test_blocks_of_texts_that_were_not_told_apart(spark, monkeypatch):
    monkeypatch.setattr(op10, "BLOCK", 6)
    monkeypatch.setattr(op10, "POINTS", 10)
    monkeypatch.setattr(op10, "_able", lambda scratch, docs, chosen, *how: chosen)
    monkeypatch.setattr(op10, "_refined", lambda scratch, sets, num, den, parts: sets)
    rows = passages(3)
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(tuple(r) for r in op10.classes(spark, d, n=3, num=60, den=100).collect()) == linked_components(rows, 3, 60, 100)


def test_keep_one_leaves_two_small_tables(spark):
    at = Path(shared_folder(spark).removeprefix("file://"))
    before = set(at.glob("bookweave/*/*"))
    d = spark.createDataFrame(passages(5), "doc_id long, text string")
    kept = op10.keep_one(spark, d)
    assert {p.name[4:] for p in set(at.glob("bookweave/*/*")) - before} == {"gone", "again"}
    assert kept.count() > 90


def test_pairs_of_blocks_are_dealt_out_by_themselves(spark):
    rows = spark.range(400).select(F.col("id").alias("row"), F.lit(1).cast("long").alias("cell"), F.col("id").alias("node"), F.lit(0).cast("long").alias("fp1"), F.col("id").alias("fp2"), F.lit(b"").alias("set"), F.lit(b"").alias("point"), F.col("id").alias("group"), F.lit(True).alias("loose"), F.lit(4).alias("blocks"), F.lit(0).alias("block"))
    grid = op10._grid(Scratch(spark, "t"), rows, 100)
    seen = grid.applyInPandas(lambda f: f[["i", "j"]].head(1).assign(n=len(f)), "i int, j int, n long")
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\([^)]*\bi#\d+[^)]*\bj#\d+", plan)
    assert {(r.i, r.j) for r in seen.collect()} == {(i, j) for j in range(4) for i in range(j + 1)}


def test_pairs_of_blocks_take_turns(spark, monkeypatch):
    """Copies that pairs of blocks take grow with the square of a cell; only a turn's are shuffled at a time."""
    sent, dealt = [], op10._dealt
    monkeypatch.setattr(op10, "SHIPPED", 1)
    monkeypatch.setattr(op10, "_dealt", lambda rows: (sent.append(rows.agg(F.sum(F.size("pairs"))).first()[0]), dealt(rows))[1])
    rows = spark.range(300).select(F.col("id").alias("row"), F.lit(1).cast("long").alias("cell"), F.col("id").alias("node"), F.lit(0).cast("long").alias("fp1"), F.col("id").alias("fp2"), F.lit(b"").alias("set"), F.lit(b"").alias("point"), F.col("id").alias("group"), (F.col("id") < 200).alias("loose"), F.lit(10).alias("blocks"), (F.col("id") % 10).cast("int").alias("block"))
    links = op10._linked(Scratch(spark, "t"), rows, lambda f: f[["i", "j"]].head(1).astype("i8").set_axis(["a", "b"], axis=1), 50)
    assert sorted(map(tuple, links.collect())) == [(i, j) for i in range(4) for j in range(i, 14)]
    assert sum(sent) == 200 * 14 + 100 * 4 and max(sent) < 4 * 300


@pytest.mark.parametrize("idents", [[5, 3, 3, 900, 7], [-(1 << 63), (1 << 63) - 1, 0, 4, -9], []])
def test_packed_keys_come_back(idents):
    """Candidate keys travel in 9 or 13 bytes, 16 before; equal keys stay equal, and idents are whole."""
    key = np.array([1 << 63, 17, 17, 400, 123456789012][: len(idents)], "u8")
    found = list(op10._short(key, np.array(idents, "i8"), 3))
    packs = [(p, b) for f in found for p, b in zip(f.piece, f.pack)]
    got = sorted((p, int(k), int(i)) for p, b in packs for k, i in zip(*op10._long([b])))
    assert got == sorted((int(k) % 3, int(k) // 3 % (1 << 40), i) for k, i in zip(key.tolist(), idents))
    assert sum(len(b) for _, b in packs) <= 9 * len(packs) + 13 * len(idents)
