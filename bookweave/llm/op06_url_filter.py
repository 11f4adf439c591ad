"""URL filters: path rules first, then link-graph propagation per host.

Rules name a host (with all its subdomains) and a path prefix; the longest rule that fits decides. Pages that no rule
fits get their host's verdict. Hosts are nodes, links between pages of different hosts are edges. Trust starts at the
hosts by the share of their pages that rules allow and follows the links (personalised PageRank); distrust starts at
the share that rules block and runs against the links, to whoever links there. A host is blocked when its distrust
exceeds its trust by more than ``threshold``.

Distrust is the part of a random surfer's personalised PageRank from the host that ends on blocked pages, trust the same
against the links; so neither shrinks with the number of hosts linked, and a host's own share is the least it has. Rounds
go on until no rank is further than ``TOLERANCE`` from its limit.

Everything is DataFrame code. Links are summed to one weighted edge per pair of hosts before anything is joined, so a
host with a third of all pages or links is pre-aggregated; ranks are a row per host. Every round
is written to the shared folder, which cuts the lineage. Without edges the seeds are the fixed point and no round is run.

Defined results: a null url or one without ``://`` has an empty host and path, no rule, and the verdict of the empty
host; null html has no links; repeated rows are judged alike; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = (("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block"))
DAMPING, THRESHOLD = 0.85, 0.5
TOLERANCE = 1e-3
LINK = r"""(?is)<a\s[^>]*?href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, else nulls. The rules become one conditional expression."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, what in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        own, slash, rest = text.partition("/")
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(slash + rest)
        name, verdict = F.when(fits, F.lit(text)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def edges(pages: DataFrame) -> DataFrame:
    """src, dst, n: links from pages of one host to another host."""
    linked = F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1)), lambda x: F.translate(x, UPPER, LOWER)))
    rows = pages.select(host(F.col("url")).alias("src"), linked.alias("dsts")).filter(F.size("dsts") > 0)
    return rows.select("src", F.explode("dsts").alias("dst")).filter("src <> dst").groupBy("src", "dst").agg(F.count("*").cast("double").alias("n"))


def propagate(scratch: Scratch, seeds: DataFrame, links: DataFrame, *, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """host, trust, distrust, each from 0 to 1 and at least the host's own share.

    Distrust is the mean of the hosts linked to, trust that of the hosts that link here, weighted by links. A round
    shrinks what is missing by ``damping``, so the largest change bounds it.
    """
    ends = links.select(F.col("src").alias("host")).union(links.select(F.col("dst").alias("host"))).distinct()
    nodes = scratch.write(seeds.join(ends, "host", "full").na.fill(0.0, ["seed_trust", "seed_distrust"]), "nodes")
    out = links.groupBy("src").agg(F.sum("n").alias("n_out"))
    into = links.groupBy("dst").agg(F.sum("n").alias("n_in"))
    links = scratch.write(links.join(out, "src").join(into, "dst").select("src", "dst", (F.col("n") / F.col("n_out")).alias("seen"), (F.col("n") / F.col("n_in")).alias("shown")), "links")
    state = nodes.select("host", F.col("seed_trust").alias("trust"), F.col("seed_distrust").alias("distrust"))
    old, change = None, 1.0
    while change * damping > tolerance * (1 - damping):
        go = links.join(state.select(F.col("host").alias("src"), "trust"), "src").groupBy(F.col("dst").alias("host")).agg(F.sum(F.col("trust") * F.col("shown")).alias("got"))
        back = links.join(state.select(F.col("host").alias("dst"), "distrust"), "dst").groupBy(F.col("src").alias("host")).agg(F.sum(F.col("distrust") * F.col("seen")).alias("blamed"))
        mixed = lambda seed, met: F.greatest(F.col(seed), (1 - damping) * F.col(seed) + damping * F.coalesce(met, seed))
        new = nodes.join(state, "host").join(go, "host", "left").join(back, "host", "left")
        new = scratch.write(new.select("host", mixed("seed_trust", "got").alias("trust"), mixed("seed_distrust", "blamed").alias("distrust"), F.greatest(F.abs(mixed("seed_trust", "got") - F.col("trust")), F.abs(mixed("seed_distrust", "blamed") - F.col("distrust"))).alias("change")), "ranks")
        change = new.agg(F.max("change")).first()[0]
        if old is not None:
            scratch.drop(old)
        old, state = new, new.drop("change")
    return state


def judge(spark: SparkSession, pages: DataFrame, *, rules: tuple[tuple[str, str], ...] = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust."""
    if len(rules) > 1000:
        raise ValueError("rules become one expression; at most 1000")
    scratch = Scratch(spark, "urls")
    named = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    named = named.withColumn("rule", rule).withColumn("said", said)
    share = lambda what: F.sum(F.when(F.col("said") == what, 1).otherwise(0)) / F.count("*")
    seeds = scratch.write(named.groupBy("host").agg(share("allow").alias("seed_trust"), share("block").alias("seed_distrust")), "seeds")
    links = scratch.write(edges(pages), "edges")
    ranks = seeds.select("host", F.col("seed_trust").alias("trust"), F.col("seed_distrust").alias("distrust")) if links.isEmpty() else propagate(scratch, seeds, links)
    verdict = F.coalesce("said", F.when(F.col("distrust") - F.col("trust") > threshold, "block").otherwise("allow"))
    return named.join(ranks.withColumnRenamed("host", "_host"), F.col("host") == F.col("_host"), "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"), "trust", "distrust")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark, table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def _oracle() -> str:
    """The same in SQL, in as many rounds as the tolerance can take."""
    fits = " ".join(
        f"WHEN (host = '{r.partition('/')[0]}' OR ends_with(host, '.{r.partition('/')[0]}')) AND starts_with(path, '/{r.partition('/')[2]}') THEN '{r}'"
        for r, _ in sorted(RULES, key=lambda r: (-len(r[0]), r[0]))
    )
    said = " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in RULES)
    url_host = lambda u: f"translate(regexp_extract(coalesce({u}, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}')"
    link = LINK.replace("'", "''")
    turns = math.ceil(math.log(TOLERANCE * (1 - DAMPING)) / math.log(DAMPING))
    return f"""
WITH RECURSIVE p AS (SELECT page_id, html, {url_host("url")} AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r AS (SELECT *, CASE {fits} END AS rule FROM p),
v AS (SELECT *, CASE rule {said} END AS said FROM r),
e AS (SELECT host AS src, unnest(list_distinct(list_transform(regexp_extract_all(coalesce(html, ''), '{link}', 1), lambda x: translate(x, '{UPPER}', '{LOWER}')))) AS dst FROM p),
c AS (SELECT src, dst, count(*)::DOUBLE AS n FROM e WHERE src <> dst GROUP BY 1, 2),
l AS (SELECT *, sum(n) OVER (PARTITION BY src) AS n_out, sum(n) OVER (PARTITION BY dst) AS n_in FROM c),
q AS (SELECT host, count_if(said = 'allow') / count(*) AS seed_trust, count_if(said = 'block') / count(*) AS seed_distrust FROM v GROUP BY 1),
n AS (SELECT host, coalesce(seed_trust, 0) AS seed_trust, coalesce(seed_distrust, 0) AS seed_distrust
      FROM q FULL JOIN (SELECT src AS host FROM c UNION SELECT dst FROM c) USING (host)),
k AS (SELECT n.host, seed_trust, seed_distrust FROM n),
s AS (SELECT 0 AS turn, host, seed_trust, seed_distrust, seed_trust AS trust, seed_distrust AS distrust FROM k
  UNION ALL
  SELECT turn + 1, m.host, any_value(m.seed_trust), any_value(m.seed_distrust),
    greatest(any_value(m.seed_trust), {1 - DAMPING} * any_value(m.seed_trust) + {DAMPING} * coalesce(sum(m.got), any_value(m.seed_trust))),
    greatest(any_value(m.seed_distrust), {1 - DAMPING} * any_value(m.seed_distrust) + {DAMPING} * coalesce(sum(m.blamed), any_value(m.seed_distrust)))
  FROM (
    SELECT s.turn, s.host, s.seed_trust, s.seed_distrust, NULL::DOUBLE AS got, NULL::DOUBLE AS blamed FROM s
    UNION ALL SELECT s.turn, l.dst, t.seed_trust, t.seed_distrust, s.trust * n / n_in, NULL FROM s JOIN l ON l.src = s.host JOIN k t ON t.host = l.dst
    UNION ALL SELECT s.turn, l.src, t.seed_trust, t.seed_distrust, NULL, s.distrust * n / n_out FROM s JOIN l ON l.dst = s.host JOIN k t ON t.host = l.src) m
  WHERE turn < {turns} AND EXISTS (SELECT 1 FROM l) GROUP BY turn, m.host),
z AS (SELECT host, arg_max(trust, turn) AS trust, arg_max(distrust, turn) AS distrust FROM s GROUP BY host)
SELECT page_id, v.host, path, rule, coalesce(said, CASE WHEN distrust - trust > {THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict
FROM v JOIN z USING (host)
"""


ORACLE = _oracle()
