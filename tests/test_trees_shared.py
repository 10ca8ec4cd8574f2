"""Shared columns, boosting in one task and dealt rows: the same trees, from few jobs and few records."""

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from demandspark import schema as S
from demandspark.operators import models as M
from demandspark.operators import trees as TR

NAMES = ["hour", "late", "noise", "wet"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    hour, noise = rng.integers(0, 24, 2500), rng.normal(size=2500)
    y = np.round(30 * np.cos(hour / 4) + 10 * noise + rng.normal(size=2500) * 5)
    rows = [(int(i), float(h), float(h > 18), float(z), float(z > 0.5), float(v)) for i, (h, z, v) in enumerate(zip(hour, noise, y))]
    return spark.createDataFrame(rows, f"id long, hour double, late double, noise double, wet double, {S.LABEL} double").persist()


def _jobs(spark, name, f):
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    try:
        return f(), len(sc.statusTracker().getJobIdsForGroup(name))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_boosting_is_one_job(spark, data):
    """Over few rows the rounds are not passes over the table."""
    b = TR.Binned(data, NAMES, S.LABEL)
    try:
        found, jobs = _jobs(spark, "boosting", lambda: TR.boosted(b, 12, 4, 0.1))
    finally:
        b.close()
    assert len(found) == 12 and jobs <= 2  # 49 before


@pytest.mark.parametrize("params", [{}, {"subsamplingRate": 0.7, "featureSubsetStrategy": "0.6"}])
def test_boosting_in_a_task_and_in_passes(data, monkeypatch, params):
    est = {"m": (GBTRegressor(maxIter=5, maxDepth=4, seed=3, **params), False)}
    one = M.train_all(data, est, features=NAMES)["m"]
    monkeypatch.setattr(TR, "LOCAL", 10)
    passes = M.train_all(data, est, features=NAMES)["m"]
    for (w, a), (v, b) in zip(one.trees, passes.trees, strict=True):
        assert w == v and (a.feature == b.feature).all() and (a.cut == b.cut).all() and np.allclose(a.value, b.value)
    assert np.allclose(one.featureImportances.toArray(), passes.featureImportances.toArray())


@pytest.mark.parametrize("cells", [TR.CELLS, 100])
def test_forest_in_tasks_and_in_passes(data, monkeypatch, cells):
    """The same trees however many rows a task takes and however many nodes' sums it holds."""
    monkeypatch.setattr(TR, "CELLS", cells)
    est, found = {"m": (RandomForestRegressor(numTrees=5, maxDepth=7, featureSubsetStrategy="all", seed=3), False)}, []
    for local, part in ((TR.LOCAL, TR.PART), (300, 500)):
        monkeypatch.setattr(TR, "LOCAL", local)
        monkeypatch.setattr(TR, "PART", part)
        found.append(M.train_all(data, est, features=NAMES)["m"])
    told = [m.transform(data).orderBy("id").select("prediction").toPandas()["prediction"].to_numpy() for m in found]
    assert np.allclose(*told) and np.allclose(*(m.featureImportances.toArray() for m in found))


def test_shared_columns_add_up():
    rng = np.random.default_rng(1)
    hour = rng.integers(0, 24, 4000)
    bins = np.array([hour, hour // 6, rng.integers(0, 32, 4000), hour > 18, rng.integers(0, 2, 4000)], np.uint8)
    widths = [24, 4, 32, 2, 2]
    columns = TR.sharing(bins, widths)
    assert len(columns) < 5 and [0, 1, 3] in [sorted(set(c) & {0, 1, 3}) for c in columns]
    plain = TR.Layout(widths, columns, [np.empty(0, np.int64)] * len(columns))
    keys = TR._combinations(plain, iter([(0, bins[:, :1000], None), (1, bins[:, 1000:], None)]))
    layout = TR.Layout(widths, columns, keys)
    at, weight, y = rng.integers(0, 3, 4000), rng.integers(1, 4, 4000), rng.integers(0, 50, 4000).astype(float)
    got = layout.by_bin(TR.sums(layout.packed(bins), layout, None, at, 3, weight, weight * y))
    for f, width in enumerate(widths):
        key = at * width + bins[f]
        lo, hi = layout.starts[f], layout.starts[f + 1]
        assert (got[0, :, lo:hi].ravel() == np.bincount(key, weight, 3 * width)).all()
        assert (got[1, :, lo:hi].ravel() == np.bincount(key, weight * y, 3 * width)).all()


def test_more_combinations_than_the_sample_shows(spark, monkeypatch):
    """Columns that don't fit a byte over all rows are taken apart."""
    rows = spark.range(20_000).select("id", *[F.when(F.col("id") % 7 == 0, (F.hash("id", F.lit(c)) % 30).cast("double")).otherwise((F.col("id") % 30).cast("double")).alias(c) for c in "ab"],
                                      (F.col("id") % 30 * 3.0).alias(S.LABEL))
    monkeypatch.setattr(TR, "sharing", lambda codes, widths: [[0, 1]])
    b = TR.Binned(rows, ["a", "b"], S.LABEL)
    try:
        assert b.starts.columns == [[0], [1]]
        (tree, _), = TR.forest(b, 1, 6, bagged=False)
        codes = np.concatenate([x.codes for x in b.blocks.collect()], axis=1)
    finally:
        b.close()
    assert codes.shape == (2, 20_000) and len(tree.feature) > 20


def test_dealt_rows_come_in_few_records(data, monkeypatch):
    """A block sends one record a tree and part, however many nodes the part has."""
    monkeypatch.setattr(TR, "LOCAL", 100)
    b = TR.Binned(data, NAMES, S.LABEL)
    seen = []
    plain = b.blocks.__class__.flatMap
    monkeypatch.setattr(b.blocks.__class__, "flatMap", lambda self, f, **k: (seen.append(plain(self, f).count()), plain(self, f, **k))[1])
    try:
        TR.forest(b, 4, 8)
        parts, blocks = 3 * b.blocks.context.defaultParallelism, b.blocks.count()
    finally:
        b.close()
    assert 0 < sum(seen) <= 4 * parts * blocks
