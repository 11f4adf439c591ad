"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Each line is good or bad. A line's features are its own counts, in bins, and those of the lines before and after it;
neighbouring labels share transition weights. Forward-backward gives each line's marginal probability of being good;
the length-weighted mean over all lines is the document's raw quality, which a logistic curve, fitted on the training
documents, turns into a probability.

Lines carry their document's label while training (weak supervision). The model is fitted on at most ``SAMPLE``
labelled documents of at most ``LONGEST`` characters, those with the smallest hashes of doc_id, of which held-out ones (crc32 of the id as text is
divisible by 5) are never part; the sample is bounded so that fitting fits on the driver, the bound being a parameter.
Scoring covers every whole text and streams; labels, lang, source and doc_id are no inputs of a score.

Defined results: null or empty text is one empty line; without labels of both kinds all scores are 0.5; null labels are
ignored; repeated rows get equal scores; an empty table gives an empty result; extra columns are ignored by score()
and kept by keep().
"""

from __future__ import annotations

from operator import eq

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_rows, parallel, table

SAMPLE, LONGEST, THRESHOLD = 3000, 50_000, 0.3
LOWER, UPPER, DIGIT, BLANK, STOP, BANG, SYMBOL, OTHER = range(8)
NAMES = ("chars", "words", "upper", "digits", "stops", "bangs", "symbols", "other", "word_length", "short", "distinct", "stutter", "seen")
BINS = 8


def _classes() -> np.ndarray:
    """The class of each character up to U+FFFF; those beyond are OTHER."""
    kind = np.full(0x10000, OTHER, "u1")
    for c in range(0x10000):
        if 0xD800 <= c < 0xE000:
            continue
        s = chr(c)
        kind[c] = UPPER if s.isupper() else LOWER if s.isalpha() else DIGIT if s.isdigit() else BLANK if s.isspace() else OTHER
    for chars, k in ((".,;:'\"-()", STOP), ("!?", BANG), ("#*$%&|<>{}[]\\/=+_~^@", SYMBOL)):
        kind[[ord(c) for c in chars]] = k
    return kind


_kind: list[np.ndarray] = []


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(lines x features, length of each line)."""
    if not _kind:
        _kind.append(_classes())
    lines = (text or "").split("\n")
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = _kind[0][np.minimum(codes, 0xFFFF)]
    which = np.cumsum(codes == 10)
    counts = np.bincount(which * 8 + kinds, minlength=8 * len(lines)).reshape(len(lines), 8).astype("f8")
    counts[:-1, BLANK] -= 1  # the line feed itself
    size = counts.sum(1)
    rows, seen = [], set()
    for line in lines:
        w = line.split()
        n = len(w) or 1
        rows.append((len(w), sum(map(len, w)) / n, sum(len(x) <= 3 for x in w) / n, len(set(w)) / n, sum(map(eq, w, w[1:])) / n, line in seen))
        seen.add(line)
    per = np.array(rows, "f8")
    share = counts / np.maximum(size, 1)[:, None]
    x = np.column_stack([size, per[:, 0], share[:, UPPER], share[:, DIGIT], share[:, STOP], share[:, BANG], share[:, SYMBOL], share[:, OTHER], per[:, 1:]])
    return x, size


class Crf:
    """Weights by feature bin for the line itself and its neighbours, and for pairs of labels."""

    def __init__(self, edges: list[np.ndarray]):
        self.edges = edges
        self.width = BINS + 1
        self.unary = np.zeros(3 * len(edges) * self.width + 1)
        self.pair = np.zeros((2, 2))
        self.curve = (1.0, 0.0)

    def places(self, x: np.ndarray) -> np.ndarray:
        """Indices of each line's active weights: own bins, those of the line before and after (or none), and a bias."""
        own = np.stack([np.searchsorted(e, x[:, k], "left") for k, e in enumerate(self.edges)], 1)
        none = np.full((1, own.shape[1]), BINS)
        at = np.concatenate([own, np.concatenate([none, own[:-1]]), np.concatenate([own[1:], none])], 1)
        return np.concatenate([at + np.arange(at.shape[1]) * self.width, np.full((len(x), 1), len(self.unary) - 1)], 1)

    def marginals(self, potentials: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Good-probabilities (docs x lines), expected label pairs, and log partition; chains side by side, padded.

        potentials: log-odds of good per line.
        """
        docs, most = potentials.shape
        a = np.zeros((docs, most, 2))
        a[:, 0, 1] = potentials[:, 0]
        for t in range(1, most):
            step = np.logaddexp.reduce(a[:, t - 1, :, None] + self.pair, axis=1)
            step[:, 1] += potentials[:, t]
            a[:, t] = np.where((t < lengths)[:, None], step, a[:, t - 1])
        total = np.logaddexp.reduce(a[:, -1], axis=1)
        b = np.zeros((docs, most, 2))
        pairs = np.zeros((2, 2))
        for t in range(most - 2, -1, -1):
            ahead = b[:, t + 1] + np.stack([np.zeros(docs), potentials[:, t + 1]], 1)
            live = t + 1 < lengths
            joint = a[:, t, :, None] + self.pair + ahead[:, None, :]
            pairs += np.exp(joint - total[:, None, None])[live].sum(0)
            b[:, t] = np.where(live[:, None], np.logaddexp.reduce(self.pair + ahead[:, None, :], axis=2), 0)
        good = np.exp(a[:, :, 1] + b[:, :, 1] - total[:, None])
        return np.clip(good, 0, 1), pairs, total


def _padded(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    out = np.zeros((len(lengths), lengths.max(initial=1)))
    out[np.arange(out.shape[1]) < lengths[:, None]] = values
    return out


def fit(texts: list[str | None], labels: np.ndarray, *, steps: int = 80, rate: float = 0.15, shrink: float = 1e-3) -> Crf | None:
    if len(set(labels.tolist())) < 2:
        return None
    rows = [line_features(t) for t in texts]
    lengths = np.array([len(x) for x, _ in rows])
    order = np.argsort(lengths, kind="stable")
    x = np.concatenate([rows[i][0] for i in order])
    size = np.concatenate([rows[i][1] for i in order])
    lengths, labels = lengths[order], labels[order].astype("f8")
    # bins by quantiles, a bin of its own for zero
    crf = Crf([np.unique(np.concatenate([[0.0], np.quantile(x[x[:, k] > 0, k] if (x[:, k] > 0).any() else [0.0], np.linspace(0.1, 0.9, BINS - 2))]))[: BINS - 1] for k in range(x.shape[1])])
    at = np.concatenate([crf.places(rows[i][0]) for i in order])
    y = np.repeat(labels, lengths)
    balance = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    groups = np.array_split(np.arange(len(labels)), max(1, len(labels) // 256))
    upto = np.concatenate([[0], np.cumsum(lengths)])
    spots = [slice(upto[g[0]], upto[g[-1] + 1]) for g in groups]
    m = [np.zeros_like(crf.unary), np.zeros((2, 2))]
    v = [np.zeros_like(crf.unary), np.zeros((2, 2))]
    for step in range(1, steps + 1):
        grad, pair = np.zeros_like(crf.unary), np.zeros((2, 2))
        for g, s in zip(groups, spots, strict=True):
            n = lengths[g]
            good, pairs, _ = crf.marginals(_padded(crf.unary[at[s]].sum(1), n), n)
            weight = np.repeat(balance[g], n)
            slope = (y[s] - good[np.arange(good.shape[1]) < n[:, None]]) * weight
            grad += np.bincount(at[s].ravel(), np.repeat(slope, at.shape[1]), len(grad))
            same = np.array([[((1 - labels[g]) * (n - 1)).sum(), 0], [0, (labels[g] * (n - 1)).sum()]])
            pair += same - pairs
        grad, pair = grad / len(y) - shrink * crf.unary, pair / len(y) - shrink * crf.pair
        for k, (w, d) in enumerate(((crf.unary, grad), (crf.pair, pair))):
            m[k] = 0.9 * m[k] + 0.1 * d
            v[k] = 0.99 * v[k] + 0.01 * d * d
            w += rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    raw = np.concatenate([_quality(crf, at[s], size[s], lengths[g]) for g, s in zip(groups, spots, strict=True)])
    crf.curve = _curve(raw, labels)
    return crf


def _quality(crf: Crf, at: np.ndarray, size: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    good, _, _ = crf.marginals(_padded(crf.unary[at].sum(1), lengths), lengths)
    weight = _padded(size + 1, lengths)
    return (good * weight).sum(1) / weight.sum(1)


def _curve(raw: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps on the penalised likelihood."""
    z = _logit(raw)
    x = np.column_stack([z, np.ones(len(z))])
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        w = w + np.linalg.solve(h, x.T @ (labels - p) - 1e-2 * (w - [1.0, 0.0]))
        w = np.clip(w, [0.05, -10], [5, 10])
    return float(w[0]), float(w[1])


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def scores(crf: Crf | None, texts: list[str | None]) -> np.ndarray:
    if crf is None:
        return np.full(len(texts), 0.5)
    out = np.empty(len(texts))
    rows = [line_features(t) for t in texts]
    lengths = np.array([len(x) for x, _ in rows])
    order = np.argsort(lengths, kind="stable")
    i = 0
    while i < len(order):  # chains of similar length side by side, a bounded number of cells at a time
        j = i + 1
        while j < len(order) and j - i < 512 and (j - i + 1) * lengths[order[j]] <= 200_000:
            j += 1
        own = order[i:j]
        at = np.concatenate([crf.places(rows[k][0]) for k in own])
        raw = _quality(crf, at, np.concatenate([rows[k][1] for k in own]), lengths[own])
        out[own] = 1 / (1 + np.exp(-(crf.curve[0] * _logit(raw) + crf.curve[1])))
        i = j
    return out


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, longest: int = LONGEST) -> Crf | None:
    """Fitted on at most ``sample`` labelled documents of at most ``longest`` characters, which bounds what the driver reads; repeated ids count once."""
    known = labels.select("doc_id", "quality").filter("quality in (0, 1) and doc_id is not null").filter(~held_out())
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample)
    short = docs.select("doc_id", "text").filter(F.coalesce(F.length("text"), F.lit(0)) <= longest)
    rows = short.join(F.broadcast(chosen.distinct()), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text")).toPandas().sort_values(["doc_id", "quality"], kind="stable")
    return fit(rows.text.tolist(), rows.quality.to_numpy("i8"))


def score(spark: SparkSession, docs: DataFrame, crf: Crf | None) -> DataFrame:
    """doc_id and score."""
    judge = lambda part: {"score": scores(crf, part.column("text").to_pylist())}
    return map_rows(parallel(spark, docs.select("doc_id", "text")), judge, "score double", drop=("text",), step=1024)


def keep(spark: SparkSession, docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score the threshold or more, with all their columns."""
    crf = train(docs, labels)
    return map_rows(docs, lambda part: {"keep": scores(crf, part.column("text").to_pylist()) >= threshold}, "", step=1024)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = score(spark, docs, train(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
