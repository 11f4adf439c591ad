"""Quality rules: ordered decision lists learned from labelled text statistics.

1. Every whole text gets counts (words, symbols, repeated lines and windows, capitals ...), with built-in functions on
   arrays; a text never leaves its row, so no shuffle depends on how long or how often repeated a text is.
2. Sequential covering over the labelled rows: a rule is grown by the threshold condition with the largest information
   gain for label 0, pruned on rows that growing did not see, accepted while precise enough, and the rows it covers
   are set aside before the next one. A rule grows while a condition gains; the list ends with the first rule that is
   less precise than ``MIN_PRECISION`` on the pruning rows, or covers fewer of them than MIN_COVER or ``MIN_SHARE`` of
   their bad ones, so it has at most some hundred rules and no cap of its own. Each step is one grouped count by
   (feature, bin) over all labelled rows; the driver sees features x bins counts, whatever the corpus.
3. The list becomes one ordered conditional expression over the counts.

Defined results: null or empty text has zero counts and fails the base rule (fewer than 10 words); labels that are
null are ignored, repeated ones count as often as they stand; without labels of both kinds the list is empty and the
base rule alone decides; repeated rows are judged alike; extra columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANKS, Scratch, parallel, table

SYMBOLS = "#*$%&|<>"
WINDOW = 5
BINS = 16
MIN_PRECISION, MIN_COVER, MIN_SHARE, SLACK = 0.8, 5, 0.005, 0.02


def counts(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of each text."""
    text = F.coalesce("text", F.lit(""))
    d = docs.select("doc_id", text.alias("text"))
    d = d.select("doc_id", "text", F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "").alias("w"), F.filter(F.split("text", "\n"), lambda x: F.translate(x, BLANKS, "") != "").alias("lines"))
    chars = lambda some: F.length("text") - F.length(F.translate("text", some, ""))
    d = d.select(
        "doc_id",
        "w",
        F.size("w").cast("long").alias("n_words"),
        (F.length("text") - chars(BLANKS)).cast("long").alias("word_chars"),
        chars(SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count("text", F.lit(r"\p{Nd}")).cast("long").alias("n_digits"),
        chars("!?").cast("long").alias("n_bangs"),
        chars(".,;:").cast("long").alias("n_stops"),
        F.aggregate("w", F.lit(0).cast("long"), lambda n, x: n + F.when(F.length(x) <= 3, 1).otherwise(0)).alias("n_short"),
    )
    kept = [c for c in d.columns if c != "w"]
    # windows by hash, the whole array only where some hash occurs twice; then, in hash order, those like a neighbour
    hashed = F.transform("w", lambda x, i: F.xxhash64(x, *(F.get("w", i + k) for k in range(1, WINDOW))))
    d = d.select(*kept, F.when(F.size("w") > WINDOW, F.slice(hashed, 1, F.greatest(F.size("w") - WINDOW + 1, F.lit(0)))).otherwise(F.array().cast("array<bigint>")).alias("h"))
    d = d.select(*kept, F.when(F.size(F.array_distinct("h")) < F.size("h"), F.col("h")).otherwise(F.array().cast("array<bigint>")).alias("h"))
    d = d.select(*kept, F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))).alias("s"))
    same = lambda x, other: F.coalesce(x["h"] == other["h"], F.lit(False))
    again = F.sort_array(F.transform(F.filter("s", lambda x, j: same(x, F.get("s", j - 1)) | same(x, F.get("s", j + 1))), lambda x: x["i"].cast("long")))
    covered = F.aggregate(
        again,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda a, i: F.struct((a["n"] + i + WINDOW - F.greatest(i, a["end"])).alias("n"), (i + WINDOW).alias("end")),
        lambda a: a["n"],
    )
    return d.select(*kept, covered.alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def features() -> dict[str, Column]:
    per = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "symbols_per_word": per("n_symbols", "n_words"),
        "chars_per_word": per("word_chars", "n_words"),
        "upper_per_char": per("n_upper", "word_chars"),
        "digits_per_char": per("n_digits", "word_chars"),
        "bangs_per_word": per("n_bangs", "n_words"),
        "stops_per_word": per("n_stops", "n_words"),
        "short_words": per("n_short", "n_words"),
        "dup_lines": per("n_dup_lines", "n_lines"),
        "repeat_words": per("n_repeat_words", "n_words"),
        "words": F.col("n_words").cast("double"),
    }


Condition = tuple[str, str, float]  # feature, ">" or "<=", threshold


def holds(rule: list[Condition]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(f) > t if op == ">" else F.col(f) <= t for f, op, t in rule), F.lit(True))


def learn(labelled: DataFrame, names: list[str]) -> list[list[Condition]]:
    """Rules for label 0. labelled: the features as doubles, bad (0/1) and part (0..2; 2 is kept for pruning)."""
    quantiles = [k / BINS for k in range(1, BINS)]
    cuts = labelled.agg(*(F.percentile_approx(n, quantiles, 10_000).alias(n) for n in names)).first()
    edges = {n: sorted(set(cuts[n] or [])) for n in names}
    # thresholds between rare bad rows get lost in the quantiles of all rows: add those of the bad ones
    worse = labelled.filter("bad = 1").agg(*(F.percentile_approx(n, [0.02, 0.1, 0.25, 0.5, 0.75, 0.9, 0.98], 10_000).alias(n) for n in names)).first()
    edges = {n: sorted({*edges[n], *(worse[n] or [])}) for n in names}
    place = lambda n: reduce(lambda a, t: a + F.when(F.col(n) > t, 1).otherwise(0), edges[n], F.lit(0))
    binned = F.explode(F.array(*(F.struct(F.lit(n).alias("feature"), place(n).alias("bin")) for n in names)))
    rules: list[list[Condition]] = []
    least = max(MIN_COVER, MIN_SHARE * (labelled.filter("part = 2 and bad = 1").count()))
    while True:
        left = labelled.filter(~reduce(lambda a, b: a | b, map(holds, rules), F.lit(False)))
        rule: list[Condition] = []
        while True:
            got = left.filter((F.col("part") < 2) & holds(rule)).select("bad", binned.alias("x")).groupBy("x.feature", "x.bin").agg(F.sum("bad").alias("p"), F.count("*").alias("n")).collect()
            best = _best(got, edges)
            if best is None:
                break
            rule.append(widen(left.filter((F.col("part") < 2) & holds(rule)), best))
        if not rule:
            return rules
        prefixes = [rule[: k + 1] for k in range(len(rule))]
        seen = left.filter("part = 2").agg(*(F.sum(F.when(holds(r), F.col("bad"))).alias(f"p{k}") for k, r in enumerate(prefixes)), *(F.sum(F.when(holds(r), 1)).alias(f"n{k}") for k, r in enumerate(prefixes))).first()
        worth = [(((seen[f"p{k}"] or 0) + 1) / ((seen[f"n{k}"] or 0) + 2), -k, seen[f"n{k}"] or 0) for k in range(len(rule))]
        precision, k, n = max(worth)
        if precision < MIN_PRECISION or n < least:
            return rules
        rules.append(prefixes[-k])
    return rules


def _best(got: list, edges: dict[str, list[float]]) -> Condition | None:
    """The condition with the largest information gain from counts by feature and bin, if any gains.

    Among thresholds of that feature and direction whose gain is within ``SLACK`` of it, the most cautious one, which
    covers the fewest rows.
    """
    by: dict[str, dict[int, tuple[int, int]]] = {}
    for r in got:
        by.setdefault(r.feature, {})[r.bin] = (r.p, r.n)
    gains: dict[tuple[str, str], list[tuple[float, int, float]]] = {}
    for f in sorted(by):
        p0, n0 = (sum(v[i] for v in by[f].values()) for i in (0, 1))
        if not p0 or p0 == n0:
            continue
        p = n = 0
        for b, t in enumerate(edges[f]):
            low = by[f].get(b, (0, 0))
            p, n = p + low[0], n + low[1]
            for op, pp, nn in (("<=", p, n), (">", p0 - p, n0 - n)):
                if pp and MIN_COVER <= nn < n0:
                    gains.setdefault((f, op), []).append((pp * (math.log2(pp / nn) - math.log2(p0 / n0)), nn, t))
    if not gains:
        return None
    f, op = max(gains, key=lambda k: max(gains[k])[0])
    most = max(gains[f, op])[0]
    if most <= 1e-9:
        return None
    _, t = min((nn, t) for gain, nn, t in gains[f, op] if gain >= (1 - SLACK) * most)
    return (f, op, t)


def widen(rows: DataFrame, condition: Condition) -> Condition:
    """The threshold put midway between the values on its two sides."""
    f, op, t = condition
    sides = rows.agg(F.max(F.when(F.col(f) <= t, F.col(f))).alias("low"), F.min(F.when(F.col(f) > t, F.col(f))).alias("high")).first()
    return (f, op, (sides.low + sides.high) / 2) if sides.low is not None and sides.high is not None else condition


def decide(rules: list[list[Condition]]) -> tuple[Column, Column]:
    """Verdict and the name of the deciding rule, as ordered conditional expressions."""
    verdict, name = F.lit(True), F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(holds(rule), False).otherwise(verdict)
        name = F.when(holds(rule), " and ".join(f"{f} {op} {t:.6g}" for f, op, t in rule)).otherwise(name)
    return verdict, name


def judge(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, all counts, base_failed, kept, rule."""
    scratch = Scratch(spark, "rules")
    rows = scratch.write(counts(parallel(spark, docs)), "counts")
    said = features()
    scored = rows.select("*", *(c.alias(n) for n, c in said.items()))
    known = labels.select(F.col("doc_id").alias("_id"), (1 - F.col("quality")).cast("long").alias("bad")).filter("bad in (0, 1)")
    # the rows that the base rule drops anyway teach nothing
    labelled = scored.filter(~base_failed()).join(known, F.col("doc_id") == F.col("_id")).select(*said, "bad", F.pmod(F.xxhash64("doc_id"), F.lit(3)).alias("part"))
    labelled = scratch.write(labelled, "labelled")
    rules = learn(labelled, list(said))
    verdict, name = decide(rules)
    return scored.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict).withColumn("rule", F.when(F.col("base_failed"), "base").otherwise(name))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judge(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
