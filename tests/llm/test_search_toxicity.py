"""Top-k search and toxicity."""

import numpy as np
from pyspark.sql import functions as F

from demandspark.llm.topk import farthest_first, search, top_products
from demandspark.llm.toxicity import evidence, fit, score_texts, segments, toxicity

from tests.llm.data import SF, edge_docs


def brute_top(rows, k=20, every=20):
    sound = {}
    for vec_id, v in rows:
        if vec_id is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        ints = tuple(int(np.floor(64 * float(x))) for x in v)
        sound[vec_id] = min(sound.get(vec_id, ints), ints)
    out = []
    for q, v in sound.items():
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in sound.items() if i != q)
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def test_top_products(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = top_products(df)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect())) == brute_top(rows)


def test_top_products_of_edge_cases(spark):
    rows = [(0, [0.5, -0.5]), (20, [0.5, -0.5]), (40, [1.0]), (60, []), (60, [0.25]), (1, [0.5, -0.5]), (2, None), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (5, [None, 1.0]), (None, [1.0, 1.0]), (6, [0.5, -0.5]), (0, [0.5, -0.5])]
    df = spark.createDataFrame([(i, v, i, "x") for i, v in rows], "vec_id long, embedding array<float>, id long, rank string")
    assert sorted(map(tuple, top_products(df, k=3).collect())) == brute_top([(i, v) for i, v in rows], k=3)
    assert top_products(df.limit(0)).count() == 0
    assert top_products(df.where("vec_id = 0")).count() == 0


def test_bounds_leave_out_clustered_rows():
    rng = np.random.default_rng(4)
    centres = rng.integers(-400, 400, (6, 16)).astype(float)
    blocks = [(np.arange(c * 300, c * 300 + 300), centres[c] + rng.integers(-3, 4, (300, 16))) for c in range(6)]
    ids, x = (np.concatenate(z) for z in zip(*blocks))
    found, evaluated = search(ids[:50], x[:50], blocks, farthest_first(x, 8), 5)
    assert evaluated < 0.8 * 50 * len(ids)
    scores = x[:50] @ x.T
    for q, (got, best) in enumerate(found):
        scores[q, q] = -np.inf
        order = np.lexsort((ids, -scores[q]))[:5]
        assert got.tolist() == ids[order].tolist() and best.tolist() == scores[q][order].tolist()


def brute_segments(scores):
    """Maximal scoring segments: the best one, then likewise to its left and right."""
    best = None
    for a in range(len(scores)):
        for b in range(a + 1, len(scores) + 1):
            s = sum(scores[a:b])
            if s > 1e-9 and (best is None or s > best[2] + 1e-9):
                best = (a, b, s)
    if best is None:
        return []
    a, b, s = best
    return brute_segments(scores[:a]) + [best] + [(x + b, y + b, z) for x, y, z in brute_segments(scores[b:])]


def test_segments():
    rng = np.random.default_rng(8)
    for _ in range(200):
        n = int(rng.integers(1, 25))
        hits = [(int(i), float(rng.choice([2.5, 4.25, -1.75]))) for i in range(n) if rng.random() < 0.4]
        scores = [-0.6] * n
        for i, s in hits:
            scores[i] = s
        got = segments(hits, n, -0.6)
        expected = brute_segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in expected], (hits, n)
        assert np.allclose([s for _, _, s in got], [s for _, _, s in expected])


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = toxicity(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    rows = got.join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").toPandas()
    order = rows.score.rank()
    n1 = int(rows.toxic.sum())
    n0 = len(rows) - n1
    auc = (order[rows.toxic == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)
    assert len(rows) > 500 and auc > 0.93 and (rows.predicted == rows.toxic).mean() > 0.95


def test_toxicity_edge_cases(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = fit(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    docs = edge_docs(spark)
    rows = score_texts(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    folds = {r.doc_id: r.held_out for r in score_texts(docs, model).collect()}
    assert folds == {r.doc_id: bool(r.h) for r in docs.select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("h")).collect()}
    none = fit(docs, labels.limit(0))
    assert {r.score for r in score_texts(docs, none).collect()} == {score for score in [1 / (1 + np.exp(-none.level))]} or len(none.scores) == 0
    assert score_texts(docs.limit(0), model).count() == 0
    nulls = spark.createDataFrame([(None, 1), (1, None), (3, 1), (3, 0)], "doc_id long, toxic int")
    assert score_texts(docs, fit(docs, nulls)).count() == docs.count()


def test_a_passage_is_found_where_it_stands():
    from demandspark.llm.toxicity import Model

    model = Model((("bad$", 6.0), ("worse$", 7.0)), -0.05, 1.0, -3.0)
    text = " ".join(["fine"] * 50 + ["bad", "and", "worse", "bad"] + ["fine"] * 300 + ["bad"])
    x, found = evidence(text, model)
    assert [(a, b) for a, b, _ in found][0] == (50, 54) and x > 0
