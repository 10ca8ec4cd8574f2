"""Distributed ordered primitives and splits against brute force."""

import numpy as np
from pyspark.sql import functions as F

from demandspark.operators import ordered as O
from demandspark.operators import profile as P
from demandspark.operators import split as SP


def test_running_totals_brute_force(spark):
    rng = np.random.default_rng(7)
    rows = [(str(g), float(v), int(w)) for g, v, w in zip(rng.integers(0, 3, 400), rng.normal(size=400), rng.integers(1, 5, 400))]
    df = spark.createDataFrame(rows, "g string, v double, w long").dropDuplicates(["g", "v"])
    got = O.running_totals(df, ["g"], ["v"], ["w"], next_of="v", num_partitions=7).collect()
    pdf = df.toPandas().sort_values(["g", "v"])
    pdf["cum"] = pdf.groupby("g")["w"].cumsum()
    pdf["nxt"] = pdf.groupby("g")["v"].shift(-1)
    want = {(r.g, r.v): (r.cum, r.nxt) for r in pdf.itertuples()}
    for r in got:
        cum, nxt = want[(r["g"], r["v"])]
        assert r["cum_w"] == cum
        assert (r["next_v"] is None and np.isnan(nxt)) or r["next_v"] == nxt


def test_global_rank_without_groups(spark):
    df = spark.range(0, 1000).withColumn("k", (F.col("id") * 7919) % 1000)
    r = O.global_rank(df, [], ["k"], num_partitions=5)
    assert sorted(x["rank"] for x in r.collect()) == list(range(1, 1001))
    assert r.where(F.col("rank") != F.col("k") + 1).count() == 0


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=501), 2)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    q = {r["prob"]: r["quantile"] for r in P.quantiles(df, ["x"], [0.25, 0.5, 0.75]).collect()}
    for p in (0.25, 0.5, 0.75):
        assert abs(q[p] - np.quantile(x, p)) < 1e-12


def test_stratified_split_is_exact_partition(spark):
    from demandspark.plans import views as V

    d = V.demand(spark, "/root/testdata/sf0.001")
    s = SP.stratified(d, "obs_id", "rented_bike_count")
    n = d.count()
    assert s.count() == n and s.select("obs_id").distinct().count() == n
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert abs(counts["test"] - 0.2 * n) <= 5 and abs(counts["val"] - 0.2 * n) <= 5
    again = SP.stratified(d, "obs_id", "rented_bike_count")
    assert s.exceptAll(again).count() == 0  # deterministic


def test_kfold_sizes(spark):
    df = spark.range(0, 11)
    f = SP.kfold(df, "id", 3)
    sizes = sorted((r["fold"], r["count"]) for r in f.groupBy("fold").count().collect())
    assert sizes == [(0, 4), (1, 4), (2, 3)]


def test_ordered_split(spark):
    df = spark.range(0, 10)
    s = {r["id"]: r["split"] for r in SP.ordered(df, "id", 0.2).collect()}
    assert [s[i] for i in range(10)] == ["train"] * 8 + ["test"] * 2
