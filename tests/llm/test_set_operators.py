"""Operators over all documents or vectors: against brute force, on awkward inputs; and the pipeline's stages."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wakeline.llm import ngram_join, topk


def plain_join(docs, words, part):
    """(n, component, links) by id, from all pairs."""
    p, q = part
    sets = {}
    for i, t in docs:
        w = (t or "").encode().lower().split()
        sets[i] = {b" ".join(w[k:k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    links = {i: [j for j, s in sets.items() if j != i and s and sets[i] and q * len(s & sets[i]) >= p * len(s | sets[i])] for i in sets}
    component = {}
    for i in sorted(sets):
        todo = [] if i in component else [i]
        while todo:
            x = todo.pop()
            if x not in component:
                component[x] = i
                todo += links[x]
    return {i: (len(sets[i]), component[i], len(links[i])) for i in sets}


def near_copies(seed, count):
    r, docs, base = random.Random(seed), [], []
    for i in range(count):
        if base and r.random() < 0.75:
            w = list(r.choice(base))
            for _ in range(r.choice([0, 0, 1, 1, 2, 3, 6, 10])):
                k = r.randrange(len(w) + 1)
                if r.random() < 0.5:
                    w.insert(k, f"x{r.randrange(30)}")
                elif w:
                    w.pop(min(k, len(w) - 1))
        else:
            w = [f"w{r.randrange(60)}" for _ in range(int(2 ** r.uniform(0, 7.5)))]
        if r.random() < 0.3:
            base.append(w)
        docs.append((i, " ".join(w)))
    return docs + [(1000, None), (1001, ""), (1002, " \n"), (1003, "A b"), (1004, "a  B")]


# The third number is the price of a chance pair: a high one makes the plan use one-deletion neighbourhoods.
@pytest.mark.parametrize("part,words,price", [((9, 10), 3, 1.0), ((4, 5), 5, 1e9), ((1, 2), 2, 1.0)])
def test_join_equals_all_pairs(spark, part, words, price):
    docs = near_copies(5, 220)
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("id", F.lit(1)).withColumn("n", F.lit("n")).repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in
           ngram_join.ngram_join(df, words=words, part=part, pair_cost=price).collect()}
    assert got == plain_join(docs, words, part)


def test_deep_segments_are_allocated_by_cost():
    assert all(b.deep == 0 for b in ngram_join.bands({50: 10, 400: 10}, (9, 10)))
    assert any(b.deep for b in ngram_join.bands({40: 10 ** 9}, (4, 5)))


def test_blocks_split_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 6)
    monkeypatch.setattr(ngram_join, "HOT_SETS", 3)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(words[:50 - i % 3] + [f"v{i}"] * (i % 2) + words[50:])) for i in range(40)]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in
           ngram_join.ngram_join(spark.createDataFrame(docs, "doc_id long, text string"), words=2, part=(4, 5)).collect()}
    assert got == plain_join(docs, 2, (4, 5))


def test_join_of_nothing_and_rows_without_id(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.ngram_join(empty).collect() == []
    rows = ngram_join.ngram_join(spark.createDataFrame([(None, "a b c d"), (4, "a b c d"), (9, "a b c d"), (9, None)], "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in rows) == [("4", 2, "4"), ("9", 0, "9"), ("9", 2, "4"), ("None", 2, "None")]


def plain_top(vectors, k, scale=64):
    import math

    sound = [(i, [math.floor(x * scale) for x in v]) for i, v in vectors if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for q, v in {i: v for i, v in sound if i % 4 == 0}.items():
        found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in sound if i != q and len(w) == len(v))
        out.update((q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k]))
    return out


def test_top_k_equals_all_products(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 60)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 16)
    monkeypatch.setattr(topk, "STEP", 7)
    r = random.Random(2)
    vectors = [(i, [r.choice([-1.0, -0.25, 0.0, 0.3, 2.0]) for _ in range(4)]) for i in range(150)]
    vectors += [(i, [r.gauss(0, 1) for _ in range(4)]) for i in range(200, 300)]
    vectors += [(400, None), (401, []), (404, [1.0, None, 0.0, 1.0]), (408, [float("nan")] * 4), (412, [float("inf"), 0.0, 0.0, 0.0]),
                (416, [1.0, 2.0]), (417, [3.0, 4.0]), (420, [1.0] * 7), (None, [1.0] * 4), (424, [0.0] * 4)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("rank", F.lit("x")).repartition(3)
    got = Counter((x.query_id, x["rank"], x.vec_id, x.score) for x in topk.top_k(df, F.col("id") % 4 == 0, k=6).collect())
    assert got == plain_top(vectors, 6)
    assert topk.top_k(df.limit(0), F.col("id") % 4 == 0).collect() == []


def test_pipeline_stages(spark):
    import corpus_pipeline as pipeline
    from wakeline.llm import pii, quality
    from wakeline.llm.queries import QUALITY_CUT, held_out

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names, stages = zip(*pipeline.STAGES)
    assert names == ("quality", "near_duplicates", "personal_data", "packing") and pipeline.ORACLE_SQL is None
    good = spark.createDataFrame(stages[0](spark, docs, folder).toPandas(), docs.schema)
    model = quality.fit_labelled(docs, spark.read.parquet(f"{folder}/labels.parquet"), "quality", ~held_out(F.col("id")))
    want = {r.doc_id for r in docs.collect() if model.score(__import__("numpy").array([quality.features(r.text)]))[0] >= QUALITY_CUT}
    assert {r.doc_id for r in good.collect()} == want and good.columns == docs.columns
    one = stages[1](spark, good, folder)
    plain = plain_join([(r.doc_id, r.text) for r in good.collect()], 5, (4, 5))
    kept = one.collect()
    assert {r.doc_id for r in kept} == {i for i, (_, c, _) in plain.items() if c == i} and one.columns == docs.columns
    one = spark.createDataFrame(kept, docs.schema)
    masked = stages[2](spark, one, folder)
    after = {r.doc_id: r for r in masked.collect()}
    assert len(after) == len(kept) and masked.columns == docs.columns
    for r in kept:
        assert not pii.base_spans(after[r.doc_id].text) and after[r.doc_id].n_chars == len(after[r.doc_id].text)
        if not pii.base_spans(r.text) and after[r.doc_id].text != r.text:
            assert "<" in after[r.doc_id].text
    packed = stages[3](spark, masked, folder).collect()
    assert {r.doc_id for r in packed} == set(after)
    fill = Counter()
    for r in packed:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 1024 and len(fill) <= 1.05 * sum(fill.values()) / 1024 + 2
