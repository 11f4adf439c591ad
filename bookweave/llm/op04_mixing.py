"""Mixing sources to target weights by hash-threshold histograms.

Every document gets a 36-bit hash of its id. Per source, tokens are summed by hash bucket (12 bits at a time), the
bucket in which the running sum crosses the budget is found, and only that bucket is split further. After three
rounds each source has one threshold, and ``hash < threshold`` is the sample: nothing is sorted, budgets are nested
(a larger budget keeps all that a smaller one keeps), and reruns agree. A source's last gap, smaller than one document,
is closed as far as one more document can.

Everything is DataFrame code. The histogram has at most 4096 rows per source and round, whatever the corpus; a source
that holds a third of all rows is spread over its buckets, and partial aggregation sums it before the shuffle.

Defined results: null or empty text has size 0 and is taken 0 words; a null source is a source of its own, last in
order; repeated ids share a hash, so they are taken or left together; an empty table gives an empty result; other
columns are ignored by plan() and kept by apply().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, bounded, free, table, word_count

BITS, ROUNDS = 12, 3
BUCKETS = 1 << BITS


def hash36(doc_id: Column) -> Column:
    """36 bits of MD5 of the id as text; any engine can recompute them."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 9), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...], most: float) -> DataFrame:
    """Per source its target: shares by weight of the total, at most ``most`` times its size, the excess reshared.

    Resharing until nothing is above its cap ends at target = min(cap, level * weight) with one level for all. Sources
    in order of cap / weight reach their caps first, so one running sum finds the level. The table has one row per
    source, not per document.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    w = sizes.withColumn("rank", F.row_number().over(order))
    w = w.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int")).cast("double"))
    w = w.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    by = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    w = (
        w.withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("turn", F.row_number().over(by))
        .withColumn("level", (F.sum("source_size").over(everything) - F.col("cap_before")) / F.col("weight_left"))
    )
    # the first source in that order that the level leaves below its cap
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("turn", "level"))).over(everything)["level"]
    return w.withColumn("target", F.least("cap", F.coalesce(level, F.lit(float("inf"))) * F.col("weight"))).select("source", "source_size", "target")


def plan(spark: SparkSession, docs: DataFrame, *, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, size, source, source_size, target, copies, taken. ``copies`` is how often the mix takes the document."""
    scratch = scratch or Scratch(spark, "mixing")
    rows = scratch.write(docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), hash36(F.col("doc_id")).alias("h")), "sizes")
    goal = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    # whole copies that everyone gives, and the words still wanted beyond them
    goal = goal.withColumn("whole", F.coalesce(F.try_divide(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)).cast("double")), F.lit(1)), F.lit(0)).cast("long"))
    goal = goal.withColumn("left", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)))
    state = scratch.write(goal.withColumn("prefix", F.lit(0).cast("long")).withColumn("under", F.lit(0.0)), "targets")
    for k in range(ROUNDS):
        shift = BITS * (ROUNDS - 1 - k)
        near = rows if k == 0 else _with(rows, bounded(state.select("source", "prefix"))).filter(F.shiftright("h", shift + BITS) == F.col("prefix")).select(rows["source"], "size", "h")
        bucket = F.shiftright("h", shift)
        counts = near.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("n"))
        running = F.sum("n").over(Window.partitionBy("source").orderBy("bucket"))
        edge = (
            _with(counts.withColumn("upto", running), state.select("source", "left", "under"))
            .filter(F.col("under") + F.col("upto") > F.col("left"))
            .groupBy(counts["source"])
            .agg(F.min_by(F.struct("bucket", (F.col("under") + F.col("upto") - F.col("n")).alias("under")), "bucket").alias("edge"))
        )
        state = scratch.write(
            _with(state, edge).select(state["source"], "source_size", "target", "whole", "left", F.coalesce("edge.bucket", F.lit(1 << (BITS * (k + 1)))).alias("prefix"), F.coalesce("edge.under", "under").alias("under")),
            f"edges{k}",
        )
    # the last bucket (equal in all 36 bits) is taken when that ends nearer to the target than leaving it
    last = _with(rows, bounded(state.select("source", "prefix"))).filter(F.col("h") == F.col("prefix")).groupBy(rows["source"]).agg(F.sum("size").alias("last"))
    taken = 2 * (F.col("left") - F.col("under")) >= F.col("last")
    limit = _with(state, last).select(
        state["source"], "source_size", "target", "whole", (F.col("prefix") + F.when(taken, 1).otherwise(0)).alias("threshold"), (F.col("left") - F.col("under") - F.when(taken, F.col("last")).otherwise(0)).alias("short")
    )
    limit = bounded(scratch.write(limit, "thresholds"))
    # what is still short is filled by one more document, the one whose size comes nearest, where that helps
    rest = _with(rows, limit).filter((F.col("h") >= F.col("threshold")) & (F.abs(F.col("size") - F.col("short")) < F.col("short")))
    best = scratch.write(rest.groupBy(rows["source"]).agg(F.min_by("h", F.struct(F.abs(F.col("size") - F.col("short")), "h")).alias("filler")), "fillers")
    limit = _with(limit, bounded(best)).select(limit["source"], "source_size", "target", "whole", "threshold", "filler")
    limit = bounded(scratch.write(limit, "limits"))
    copies = F.col("whole") + F.when((F.col("h") < F.col("threshold")) | F.coalesce(F.col("h") == F.col("filler"), F.lit(False)), 1).otherwise(0)
    return _with(rows, limit).select(rows["doc_id"], rows["size"], rows["source"], "source_size", "target", copies.alias("copies"), (copies * rows["size"]).alias("taken"))


def _with(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on source, null equal to null. The right side has a row per source, counted before it is broadcast."""
    return left.join(right.withColumnRenamed("source", "_source"), left["source"].eqNullSafe(F.col("_source")), "left").drop("_source")


def apply(spark: SparkSession, docs: DataFrame, **how) -> DataFrame:
    """The mix itself: each document as many times as plan() takes it, with its own columns."""
    scratch = Scratch(spark, "mixing")
    ident, copies, turn = (free(c, docs) for c in ("mix_id", "mix_copies", "mix_turn"))
    mix = plan(spark, docs, scratch=scratch, **how).groupBy(F.col("doc_id").alias(ident)).agg(F.max("copies").cast("int").alias(copies)).filter(F.col(copies) > 0)
    joined = docs.join(bounded(scratch.write(mix, "copies")), docs["doc_id"].eqNullSafe(F.col(ident)))
    return joined.withColumn(turn, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*[docs[c] for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan(spark, table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(doc_id::VARCHAR), 1, 9))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) AS rk FROM d GROUP BY source),
w AS (SELECT *, ((rk - 1) % 3 + 1)::DOUBLE AS weight, source_size * 3.0::DOUBLE AS cap FROM s),
o AS (SELECT *, coalesce(sum(cap) OVER b, 0) AS cap_before, sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS weight_left,
             sum(source_size) OVER () AS everything, row_number() OVER (ORDER BY cap / weight, rk) AS turn FROM w
      WINDOW b AS (ORDER BY cap / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min((everything - cap_before) / weight_left, turn) FILTER (WHERE (everything - cap_before) / weight_left * weight <= cap) AS level FROM o),
g AS (SELECT source, source_size, least(cap, level * weight) AS target FROM o, l),
c AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size) END AS whole FROM g),
b AS (SELECT d.*, c.source_size, c.target, c.whole, greatest(c.target - c.whole * c.source_size, 0) AS budget,
             sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE UNBOUNDED PRECEDING) AS upto,
             sum(size) OVER (PARTITION BY d.source, h) AS same
      FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source),
k AS (SELECT *, CASE WHEN upto <= budget THEN 1 WHEN upto - same <= budget AND 2 * (budget - (upto - same)) >= same
                          THEN 1 ELSE 0 END AS extra FROM b),
r AS (SELECT source, budget - sum(size * extra) AS short FROM k GROUP BY source, budget),
p AS (SELECT k.source, arg_min(h, (abs(size - short), h)) AS filler FROM k JOIN r ON k.source IS NOT DISTINCT FROM r.source
      WHERE extra = 0 AND abs(size - short) < short GROUP BY 1)
SELECT doc_id, size, source_size, target, ((whole + CASE WHEN h = filler THEN 1 ELSE extra END) * size)::BIGINT AS taken
FROM k LEFT JOIN p ON k.source IS NOT DISTINCT FROM p.source
"""
