import corpus_pipeline
from bookweave.llm import op02_sentencepiece as op2
from bookweave.llm import queries


def test_stages_follow_each_other(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts, columns = [docs.count()], docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == columns
        docs = docs.cache()
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] == counts[3] and counts[4] > 0
    texts = {(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()}
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).select("doc_id", "ids").collect()
    v = op2.Vocabulary(op2.model())
    assert len(out) == counts[4] and {(r.doc_id, v.decode(r.ids)) for r in out} == texts


def test_every_stage_keeps_what_brute_force_keeps(spark, tmp_path):
    """Copies, near copies, shared passages, nulls, empty and long texts, repeated rows and clashing names, stage by stage."""
    from pyspark.sql import functions as F

    from bookweave.llm import op04_mixing as op4

    from test_operators import cut_by_row, linked_components, text, words

    import random

    r = random.Random(21)
    base, passage = [text(r.randint(30, 90), r) for _ in range(12)], text(55, r)
    rows = [(i, r.choice(base) + r.choice(["", " one more", " " + passage]), f"s{i % 3}", 0) for i in range(60)] + [(100 + i, text(40, r) + " " + passage + " " + text(40, r), "s1", 0) for i in range(8)]
    rows += [(200, None, "s0", 0), (201, "", None, 0), (202, " \n ", "s0", 0), (203, text(20_000, r), "s2", 0), (None, text(50, r), "s1", 0), (None, text(50, r), "s1", 0), (300, base[0], "s0", 0)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").withColumn("lang", F.lit("en")).select("*", *(F.lit(1).alias(c) for c in ("cell", "row", "rep", "gone", "copies", "keep", "label")))
    (stages := dict(corpus_pipeline.STAGES)).pop("quality classifier")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    assert corpus_pipeline.STAGES[0][1](spark, d, f"file://{tmp_path}").count() == len(rows)  # nothing learned, nothing rejected
    one = stages["n-gram Jaccard join"](spark, d, "").cache()
    left = [x for x in linked_components([(i, t) for i, t, *_ in rows if i is not None], 5, 8, 10) if x[0] == x[2]]
    assert one.columns == d.columns and sorted(x.doc_id for x in one.filter("doc_id is not null").collect()) == sorted(x[0] for x in left) and one.filter("doc_id is null").count() == 2
    cut = stages["substring dedup"](spark, one, "").cache()
    want = {(x[0], x[1] - x[2]) for x in cut_by_row([(x.doc_id, x.text) for x in one.collect()])}
    assert {(x.doc_id, len(words(x.text))) for x in cut.collect()} == want
    mixed = stages["mixing sources to target weights"](spark, cut, "").cache()
    plan = {(x.doc_id, x.source): x.copies for x in op4.plan(spark, cut).filter("doc_id is not null").collect()}
    got = {}
    for x in mixed.filter("doc_id is not null").collect():
        got[x.doc_id, x.source] = got.get((x.doc_id, x.source), 0) + 1
    assert got == {k: n for k, n in plan.items() if n}
    v = op2.Vocabulary(op2.model())
    out = stages["SentencePiece encoding"](spark, mixed, "").select("doc_id", "ids").collect()
    assert sorted((str(x.doc_id), v.decode(x.ids)) for x in out) == sorted((str(x.doc_id), x.text or "") for x in mixed.collect())
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, d.limit(0), f"file://{tmp_path}").count() == 0


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op")) == list(range(1, 11))
