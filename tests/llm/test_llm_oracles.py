"""Queries with SQL give DuckDB's rows: on the test tables, and on small tables with links, copies, nulls and shared ids."""

import random

import duckdb
import pytest

from bookweave.llm import op06_url_filter as op6
from bookweave.llm import op08_exact_topk as op8
from bookweave.llm.queries import ORACLES, QUERIES

TABLES = "documents embeddings pages benchmark labels conversations".split()


def plain(v):
    return round(v, 5) if isinstance(v, float) else v


def same(spark_rows, columns, con, sql):
    q = con.execute(sql)
    names = [d[0] for d in q.description]
    want = sorted(str([plain(dict(zip(names, r))[c]) for c in columns]) for r in q.fetchall())
    return sorted(names) == sorted(columns) and sorted(str([plain(r[c]) for c in columns]) for r in spark_rows) == want


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got = QUERIES[name](spark, sf_dir)
    assert same(got.collect(), got.columns, con, ORACLES[name])


def test_ranks_over_links_are_those_of_the_sql(spark):
    r = random.Random(8)
    hosts = [f"h{i}.io" for i in range(25)] + ["a.com", "b.com", "c.net"]
    rows = [(i, f"http://{r.choice(hosts)}/{r.choice(['en/1', 'x', 'de/8', ''])}", "".join(f'<a href="http://{r.choice(hosts)}/">' for _ in range(r.randint(0, 4)))) for i in range(90)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = op6.judge(spark, pages)
    con = duckdb.connect()
    con.execute("CREATE TABLE pages(page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    columns = ["page_id", "host", "path", "rule", "verdict"]
    assert same(got.select(columns).collect(), columns, con, op6.ORACLE)
    # and of a dense iteration to the fixed point
    import numpy as np

    names = sorted({x.host for x in got.collect()} | {d for _, _, h in rows for d in [p.split("/")[0] for p in h.split("http://")[1:]]})
    at = {h: i for i, h in enumerate(names)}
    n = np.zeros((len(names),) * 2)
    for e in op6.edges(pages).collect():
        n[at[e.src], at[e.dst]] = e.n
    seed = np.zeros((2, len(names)))
    for h in names:
        own = [x for x in got.collect() if x.host == h]
        for k, what in enumerate(("allow", "block")):
            seed[k, at[h]] = sum(x.rule is not None and dict(op6.RULES)[x.rule] == what for x in own) / max(len(own), 1)
    go = np.divide(n, n.sum(0)[None], out=np.zeros_like(n), where=n.sum(0)[None] > 0).T  # mean over who links here
    back = np.divide(n, n.sum(1)[:, None], out=np.zeros_like(n), where=n.sum(1)[:, None] > 0)
    trust, distrust = seed.copy()
    for _ in range(300):
        for state, s, m in ((trust, seed[0], go), (distrust, seed[1], back)):
            met = np.where(m.sum(1) > 0, m @ state, s)
            state[:] = np.maximum(s, 0.15 * s + 0.85 * met)
    for x in got.collect():
        assert abs(x.trust - trust[at[x.host]]) < op6.TOLERANCE and abs(x.distrust - distrust[at[x.host]]) < op6.TOLERANCE


def test_a_long_chain_of_links_is_followed_to_its_end(spark):
    rows = [(0, "http://bad.com/en/1", "")] + [(i, f"http://c{i}.io/", f'<a href="http://{"bad.com" if i == 1 else f"c{i - 1}.io"}/">') for i in range(1, 31)]
    got = {r.host: r.distrust for r in op6.judge(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(abs(got[f"c{i}.io"] - 0.85**i) < op6.TOLERANCE for i in range(1, 31)) and got["c20.io"] > 0


def test_rows_with_one_id_are_queries_and_candidates_of_their_own(spark):
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (50, [0.0, 1.0]), (1, [0.5, 0.0]), (2, [0.0, 0.25]), (3, [0.1, 0.1])]
    from pyspark.sql import functions as F

    got = op8.search(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0)
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings(vec_id BIGINT, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", [(i, v) for i, v in rows])
    assert same(got.collect(), got.columns, con, op8.ORACLE) and got.count() == 15
