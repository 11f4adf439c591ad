"""Exact top-k search by inner product with pivot-table elimination.

The pivot table holds every vector's distances to ``pivots`` fixed vectors. By the triangle inequality the distance of
query and candidate is at least the largest difference of their entries, so the inner product is at most
(|q|^2 + |v|^2 - bound^2) / 2. Candidates that are close in the table form tiles, a tile's bound being the best that
its range of entries allows; each query opens tiles in the order of that bound until its k-th best score exceeds all
bounds that are left. In an opened tile each candidate has its own bound from all pivots; candidates are evaluated in
the order of that bound, as matrix products, until no query can gain. Where these bounds exclude less than ``WORTH`` of a
tile they cost more than they save, so most tiles are then evaluated whole; every sixteenth tries again. The result is
exact, ties going to the smaller id.

Queries are handled in blocks of bounded size that are sent to the tasks; each task streams its part of the pivot
table past them and keeps k candidates per query, and a grouped top-k merges the tasks. Nothing else is collected. The
pivots are picked on the driver from a bounded sample (``SAMPLE`` rows, smallest hashes of the id); they affect speed only.

Defined results: vectors that are null, empty, or hold a null or a component that is not finite take no part, as query
or candidate; query and candidate must have as many components; a row is not its own candidate, but other rows with its
id or its components are; each query row has its own list, so rows that share an id give lists under the same query_id;
repeated candidate rows each count; scores beyond a long are an error; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, parallel, table

PIVOTS, SAMPLE, BLOCK, SCALE = 32, 2048, 8192, 256
TILE, STEP = 512, 64
WORTH, PROBE = 0.8, 16


def quantised(v, scale: int) -> np.ndarray | None:
    if v is None:
        return None
    x = np.floor(np.asarray([math.nan if c is None else c for c in v] if not isinstance(v, np.ndarray) or v.dtype == object else v, dtype="f8") * scale)
    return x if x.size and np.isfinite(x).all() else None


def spread(sample: np.ndarray, n: int) -> np.ndarray:
    """Pivots far from each other: each next one is the vector farthest from those before."""
    chosen, near = [0], np.full(len(sample), np.inf)
    while len(chosen) < min(n, len(sample)):
        near = np.minimum(near, ((sample - sample[chosen[-1]]) ** 2).sum(1))
        if not near.max():
            break
        chosen.append(int(near.argmax()))
    return sample[chosen]


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None] - 2 * (x @ pivots.T), 0))


def scores(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products, queries by rows; floats are exact below 2**53."""
    if np.abs(rows).max(initial=0) * np.abs(q).max(initial=0) * q.shape[1] < 2**53:
        return q @ rows.T
    whole = lambda x: np.array([[int(c) for c in r] for r in x], object)
    return whole(q) @ whole(rows).T


class Searcher:
    """Keeps the k best candidates of each query of a block while the pivot table streams past."""

    def __init__(self, rows: np.ndarray, x: np.ndarray, dist: np.ndarray, k: int):
        self.rows, self.x, self.dist, self.k = rows, x, dist, k
        self.norm = (x * x).sum(1)
        self.best: list[list[tuple[int, int, int]]] = [[] for _ in rows]  # (-score, id, row), sorted
        self.floor = np.full(len(rows), -np.inf)  # the k-th best score
        self.evaluated = self.opened = 0
        self.excluded = 1.0  # the share of the last tile tried that candidates' own bounds excluded

    def feed(self, rows: np.ndarray, ids: np.ndarray, x: np.ndarray, dist: np.ndarray) -> None:
        near = dist.argmin(1) if dist.shape[1] else np.zeros(len(ids), "i8")
        order = np.lexsort((dist[np.arange(len(ids)), near] if dist.shape[1] else near, near))
        tiles = [order[i : i + TILE] for i in range(0, len(order), TILE)]
        norm = (x * x).sum(1)
        bound = np.empty((len(self.rows), len(tiles)))
        for t, own in enumerate(tiles):
            low = np.zeros(len(self.rows))
            for p in range(dist.shape[1]):
                d, q = dist[own, p], self.dist[:, p]
                low = np.maximum(low, np.maximum(d.min() - q, q - d.max()))
            bound[:, t] = _most(norm[own].max(), self.norm, low)
        turn = np.argsort(-bound, axis=1, kind="stable")
        every = np.arange(len(self.rows))
        for r in range(len(tiles)):
            now = turn[:, r]
            alive = bound[every, now] >= self.floor
            if not alive.any():
                break
            for t in np.unique(now[alive]):
                own = tiles[t]
                self._open(np.flatnonzero(alive & (now == t)), rows[own], ids[own], x[own], norm[own], dist[own])

    def _open(self, queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, x: np.ndarray, norm: np.ndarray, dist: np.ndarray) -> None:
        """Candidates of a tile in the order of their own bounds, until no query can gain."""
        self.opened += 1
        if self.excluded < WORTH and self.opened % PROBE:
            return self._evaluate(queries, rows, ids, x)
        low = np.zeros((len(queries), len(rows)))
        for p in range(dist.shape[1]):
            np.maximum(low, np.abs(self.dist[queries, p][:, None] - dist[:, p][None]), out=low)
        bound = _most(norm[None], self.norm[queries][:, None], low)
        order = np.argsort(-bound.max(0), kind="stable")
        done = 0
        for at in range(0, len(order), STEP):
            rest = order[at:]
            alive = bound[:, rest] >= self.floor[queries][:, None]
            some, now = alive.any(1), rest[:STEP]
            if not some.any():
                break
            self._evaluate(queries[some], rows[now], ids[now], x[now])
            done += int(some.sum()) * len(now)
        self.excluded = 1 - done / max(low.size, 1)

    def _evaluate(self, queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        s = scores(self.x[queries], x)
        self.evaluated += s.size
        hit = (s >= self.floor[queries][:, None]) & (rows[None] != self.rows[queries][:, None])
        for i in np.flatnonzero(hit.any(1)):
            q, at = queries[i], np.flatnonzero(hit[i])
            if len(at) > 4 * self.k:
                at = at[np.lexsort((ids[at], -s[i, at]))[: self.k]]
            self.best[q] = sorted([*self.best[q], *((-int(s[i, j]), int(ids[j]), int(rows[j])) for j in at)])[: self.k]
            if len(self.best[q]) == self.k:
                self.floor[q] = -self.best[q][-1][0]


def _most(norm, query_norm, low):
    """The largest inner product at a distance of ``low`` or more; rounding must never push it below the true score."""
    return (norm + query_norm - low * low) / 2 + 1e-9 * (norm + query_norm) + 1e-6


def search(spark: SparkSession, vectors: DataFrame, is_query: Column, *, k: int = 5, scale: int = SCALE, pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score for all rows of vectors(vec_id, embedding) that is_query selects."""
    scratch = Scratch(spark, "topk")
    rows = vectors.select("vec_id", "embedding", is_query.alias("is_query")).filter("vec_id is not null and embedding is not null")
    sample = [x for r in rows.select("embedding", F.xxhash64("vec_id").alias("h"), "vec_id").orderBy("h", "vec_id").limit(SAMPLE).collect() if (x := quantised(r.embedding, scale)) is not None]
    centres = {d: spread(np.stack(own), pivots) for d in {len(x) for x in sample} if (own := [x for x in sample if len(x) == d])}

    def tabled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            x = [quantised(v, scale) for v in f.embedding]
            keep = [i for i, v in enumerate(x) if v is not None]
            dist = [distances(x[i][None], centres[len(x[i])])[0] if len(x[i]) in centres else np.zeros(0) for i in keep]
            yield pd.DataFrame({"vec_id": f.vec_id.iloc[keep], "is_query": f.is_query.iloc[keep].fillna(False).astype(bool), "dims": [len(x[i]) for i in keep], "code": [x[i].tobytes() for i in keep], "dist": [d.tobytes() for d in dist]})

    index = scratch.write(parallel(spark, rows).mapInPandas(tabled, "vec_id long, is_query boolean, dims int, code binary, dist binary").withColumn("row", F.monotonically_increasing_id()), "pivots")
    asked = index.filter("is_query")
    n = asked.count()
    blocks = max(1, -(-n // block))
    found = []
    for b in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).select("row", "vec_id", "dims", "code", "dist").toPandas()
        hits = index.mapInPandas(_scan(own, k), "query_row long, query_id long, row long, vec_id long, score long")
        found.append(hits if blocks == 1 else scratch.write(hits, f"block{b}"))
    hits = found[0]
    for h in found[1:]:
        hits = hits.unionByName(h)
    top = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return hits.withColumn("rank", F.row_number().over(top)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _scan(own: pd.DataFrame, k: int):
    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by = {}
        for d, g in own.groupby("dims"):
            by[d] = Searcher(g.row.to_numpy("i8"), np.stack([np.frombuffer(c) for c in g.code]), np.stack([np.frombuffer(c) for c in g.dist]), k)
        ids = dict(zip(own.row.tolist(), own.vec_id.tolist(), strict=True))
        for f in frames:
            for d, g in f.groupby("dims"):
                if d in by:
                    by[d].feed(g.row.to_numpy("i8"), g.vec_id.to_numpy("i8"), np.stack([np.frombuffer(c) for c in g.code]), np.stack([np.frombuffer(c) for c in g.dist]))
        rows = [(q, ids[q], r, i, -s) for x in by.values() for q, best in zip(x.rows.tolist(), x.best, strict=True) for s, i, r in best]
        yield pd.DataFrame(rows, columns=["query_row", "query_id", "row", "vec_id", "score"])

    return scan


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLE = """
WITH e AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
      FROM e q JOIN e c ON c.r <> q.r AND len(c.v) = len(q.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) <= 5
"""
