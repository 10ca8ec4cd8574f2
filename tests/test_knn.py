"""Exact k-NN over Voronoi cells against numpy brute force."""

import tracemalloc

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from demandspark.operators.knn import CHUNK, _meeting, knn_regress, shipped_pairs


def test_knn_equals_brute_force(spark):
    rng = np.random.default_rng(11)
    centers = 5 * rng.normal(size=(4, 8))
    pts = np.vstack([c + 0.3 * rng.normal(size=(60, 8)) for c in centers])
    labels = np.repeat(np.arange(4), 60).astype(float) + rng.normal(scale=0.1, size=240)
    rows = [(i, [float(x) for x in p], float(y)) for i, (p, y) in enumerate(zip(pts, labels))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label double")
    ref, qry = df.where(F.col("vec_id") % 4 != 0), df.where(F.col("vec_id") % 4 == 0)
    got = {r["vec_id"]: r["prediction"] for r in knn_regress(ref, qry, k=5, pivots=8, chunk=50).collect()}
    p32 = pts.astype(np.float32).astype(np.float64)
    ref_ids = [i for i in range(240) if i % 4]
    for q in range(0, 240, 4):
        d = np.sqrt(((p32[ref_ids] - p32[q]) ** 2).sum(axis=1))
        order = sorted(range(len(ref_ids)), key=lambda j: (d[j], ref_ids[j]))[:5]
        want = float(np.mean([labels[ref_ids[j]] for j in order]))
        assert abs(got[q] - want) < 1e-9
    assert knn_regress(ref, qry.limit(0), k=5).count() == 0
    assert knn_regress(ref.limit(0), qry, k=5).count() == 0
    assert {r["neighbours"] for r in knn_regress(ref.limit(3), qry, k=5).collect()} == {3}


def test_parts_go_only_where_bounds_leave_them(spark):
    """40 clusters, sets and parts of at most about 50: brute force is met, and few pairs are evaluated or shipped."""
    rng = np.random.default_rng(3)
    centers = 20 * rng.normal(size=(40, 16))
    pts = np.vstack([c + rng.normal(size=(75, 16)) for c in centers]) + 100  # far from the origin: rounding counts
    labels = rng.normal(size=len(pts))
    df = spark.createDataFrame([(i, p.tolist(), float(y)) for i, (p, y) in enumerate(zip(pts, labels))],
                               "vec_id long, embedding array<double>, label double")
    ref, qry = df.where(F.col("vec_id") % 3 != 0), df.where(F.col("vec_id") % 3 == 0)
    got = {r["vec_id"]: r["prediction"] for r in knn_regress(ref, qry, k=4, pivots=40, chunk=50).collect()}
    rid = np.array([i for i in range(len(pts)) if i % 3])
    for q in range(0, len(pts), 3):
        d = np.sqrt(((pts[rid] - pts[q]) ** 2).sum(1))
        assert abs(got[q] - labels[rid[np.lexsort((rid, d))[:4]]].mean()) < 1e-9
    share = shipped_pairs(ref, qry, k=4, pivots=40, chunk=50)
    assert share["evaluated"] < 0.06 and share["shipped"] < 0.06, share  # one cluster is 0.025 of all


def test_equal_vectors_and_repeated_rows(spark):
    """A third of all rows are one vector: ties go to the smaller key, parts stay small."""
    rows = [(i, [1.0, 1.0], float(i)) for i in range(300)] + [(1000 + i, [float(i), -1.0], 0.0) for i in range(600)]
    rows += [(5000, None, 1.0), (None, [1.0, 1.0], 1.0), (5001, [1.0, 1.0], None)]
    ref = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label double")
    qry = spark.createDataFrame([(1, [1.0, 1.0]), (2, [400.0, -1.0]), (3, None)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["prediction"], r["neighbours"]) for r in knn_regress(ref, qry, k=5, pivots=4, chunk=20).collect()}
    assert got == {1: (2.0, 5), 2: (0.0, 5)}


def test_bounds_exclude_little_in_many_dimensions(spark):
    """Measured on the given 64-dimensional vectors: nearly all pairs are evaluated, so the product itself must be cheap."""
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    share = shipped_pairs(df.where(F.col("vec_id") % 5 != 0), df.where(F.col("vec_id") % 5 == 0))
    assert 0.5 < share["evaluated"] <= 1.0


def test_a_meeting_of_full_blocks_holds_no_table_of_all_distances():
    """A table of CHUNK x CHUNK distances is 134 MB, and working it out takes a few of them."""
    rng = np.random.default_rng(5)
    q = pd.DataFrame({"qid": np.arange(CHUNK), "qv": list(rng.normal(size=(CHUNK, 8)))})
    r = pd.DataFrame({"rid": np.arange(CHUNK), "rv": list(rng.normal(size=(CHUNK, 8))), "y": rng.normal(size=CHUNK)})
    tracemalloc.start()
    try:
        got = _meeting(q, r, 5)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 100e6, most
    i = CHUNK - 1
    d = np.sqrt(((np.stack(r["rv"]) - q["qv"][i]) ** 2).sum(1))
    assert got[got["qid"] == i]["rid"].tolist() == np.argsort(d)[:5].tolist()
