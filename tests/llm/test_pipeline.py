"""The pipeline end to end, each stage against a brute-force version on its own input."""

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import brute_leaks, brute_near, brute_substrings, odd  # noqa: F401  (a fixture)
from tidemark.llm import quality_model
from tidemark.llm.queries import remainder
from tidemark.llm.work import saved, table


def test_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns, seen = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "test")
        assert docs.columns == columns
        seen.append(docs)
    rows = [[(r.doc_id, r.text) for r in d.select("doc_id", "text").collect()] for d in seen]
    scores = quality_model.classify(seen[0], table(spark, sf_dir, "labels"), "quality", remainder(5) == 0)
    assert {i for i, _ in rows[1]} == {r.doc_id for r in scores.where("predicted = 1").collect()}
    assert {i for i, _ in rows[2]} == {r[0] for r in brute_near(rows[1], 5, 80) if r[3]}
    import hashlib

    want = {i: (h, n) for i, _, n, h in brute_substrings(rows[2], 50)}
    before = dict(rows[2])
    for i, t in rows[3]:
        h, n = want[i]
        assert t == before[i] if not n else hashlib.sha256(t.encode()).hexdigest() == h
    items = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    assert {i for i, _ in rows[4]} == {i for i, _ in rows[3]} - {d for d, _ in brute_leaks(rows[3], items)}
    last = corpus_pipeline.STAGES[-1][1](spark, seen[4], sf_dir)
    assert sorted(r.doc_id for r in last.collect()) == sorted(i for i, _ in rows[4])
    by = last.groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("w")).collect()
    assert all(abs(r.t - r.w) <= 1 for r in by)
    got = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, last.collect()), key=str)


def test_empty_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.count() == 0


def test_odd_rows_end_to_end(spark, sf_dir, odd):
    """Null and shared ids, null and blank texts, repeated rows and a very long word, through all stages."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = table(spark, sf_dir, "documents").select(columns).limit(60).unionByName(odd.select(columns))
    docs = docs.unionByName(docs.where("doc_id = 3").withColumn("text", F.lit("other words under the id of another row, and more of them")))
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "test")
        assert docs.columns == columns
        seen.append(docs)
    rows = [[(r.doc_id, r.text) for r in d.collect()] for d in seen]
    assert all(Counter(i for i, _ in b) <= Counter(i for i, _ in a) for a, b in zip(rows, rows[1:]))  # rows go, none come
    kept = Counter(i for i, _ in rows[2])
    assert kept[None] == Counter(i for i, _ in rows[1])[None]  # a null id is near nothing
    alone = {i for i, n in Counter(i for i, _ in rows[1]).items() if n == 1 and i is not None}
    want = {r[0] for r in brute_near(rows[1], 5, 80) if r[3] and r[0] in alone}
    assert {i for i, _ in rows[2] if i in alone} == want
    last = corpus_pipeline.STAGES[-1][1](spark, seen[4], sf_dir).collect()
    assert Counter(r.doc_id for r in last) == Counter(i for i, _ in rows[4]) and all(0 <= r.taken <= 3 * r.size for r in last)
