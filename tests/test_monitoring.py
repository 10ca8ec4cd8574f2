"""Drift statistics, quality and alerts."""

import numpy as np
from pyspark.sql import functions as F

from demandspark.operators import drift as DR
from demandspark.operators import monitor as MO


def _ks_brute(a, b):
    grid = np.union1d(a, b)
    fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    return np.max(np.abs(fa - fb)), np.sum(np.abs(fa - fb)[:-1] * np.diff(grid))


def test_ks_and_wasserstein_brute_force(spark):
    rng = np.random.default_rng(1)
    a, b = np.round(rng.normal(0, 1, 300), 1), np.round(rng.normal(0.3, 1, 250), 1)
    ra = spark.createDataFrame([(float(x),) for x in a], "x double")
    rb = spark.createDataFrame([(float(x),) for x in b], "x double")
    r = DR.numeric_drift(ra, rb, ["x"]).first()
    d, w = _ks_brute(a, b)
    assert abs(r["statistic"] - d) < 1e-12
    assert abs(r["wasserstein_norm"] - w / np.std(a, ddof=1)) < 1e-9
    assert 0.0 <= r["p_value"] <= 1.0
    # symmetric statistic
    assert abs(DR.numeric_drift(rb, ra, ["x"]).first()["statistic"] - d) < 1e-12


def test_ks_zero_on_identical(spark):
    df = spark.range(0, 200).select((F.col("id") % 17).cast("double").alias("x"))
    r = DR.numeric_drift(df, df, ["x"]).first()
    assert r["statistic"] == 0.0 and r["p_value"] == 1.0


def test_shifted_fixture_ks_temperature(spark):
    from demandspark.plans import views as V

    ref, cur = V.reference_current(spark, "/root/testdata/sf0.01", shifted=True)
    r = DR.numeric_drift(ref, cur, ["temperature_c"]).first()
    assert round(r["statistic"], 9) == 0.093333333


def test_chi_square_and_magnitudes(spark):
    ref = spark.createDataFrame([("a",)] * 50 + [("b",)] * 50, "c string")
    cur = spark.createDataFrame([("a",)] * 80 + [("b",)] * 20, "c string")
    chi = DR.categorical_drift(ref, cur, ["c"]).first()
    # 2x2 table, expected 65/35 per row
    want = sum((o - e) ** 2 / e for o, e in ((50, 65), (80, 65), (50, 35), (20, 35)))
    assert abs(chi["statistic"] - want) < 1e-9 and chi["dof"] == 1
    p = DR.chi_square_p_values(ref, cur, ["c"]).first()["p_value"]
    assert p < 0.001
    m = DR.binned_magnitudes(ref, cur, [], ["c"]).first()
    pa, pb = np.array([0.5, 0.5]), np.array([0.8, 0.2])
    mm = (pa + pb) / 2
    js = np.sqrt(0.5 * np.sum(pa * np.log(pa / mm)) + 0.5 * np.sum(pb * np.log(pb / mm)))
    assert abs(m["js_distance"] - js) < 1e-12
    assert abs(m["psi"] - np.sum((pb - pa) * np.log(pb / pa))) < 1e-12


def test_quality_counts_raw_nulls(spark):
    df = spark.createDataFrame([(1.0, "x"), (None, "x"), (float("nan"), None), (1.0, "x")], "a double, b string")
    q = MO.quality(df).first()
    assert q["total_rows"] == 4 and q["missing_total"] == 3 and q["duplicate_rows"] == 1
    assert q["missing_values"] == {"a": 2, "b": 1}
    q0 = MO.quality(df, zero_fill_first=True).first()
    assert q0["missing_values"]["a"] == 0


def _alerts(spark, detected, rows, r2):
    summ = spark.createDataFrame([(detected, 0.6 if detected else 0.1)], "drift_detected boolean, drift_score double")
    q = spark.createDataFrame([(rows,)], "total_rows long")
    p = spark.createDataFrame([(r2,)], "r2_score double")
    return [(r["type"], r["severity"]) for r in MO.alerts(summ, q, p).collect()]


def test_alert_thresholds(spark):
    assert _alerts(spark, False, 99, 0.9) == [("data_quality", "medium")]
    assert _alerts(spark, False, 100, 0.7) == []
    assert _alerts(spark, False, 100, 0.69) == [("model_performance", "high")]
    assert ("data_drift", "high") in _alerts(spark, True, 100, 0.9)


def test_status(spark):
    summ = spark.createDataFrame([(False,)], "drift_detected boolean")
    q = spark.createDataFrame([(0,)], "missing_total long")
    assert MO.status(summ, q).first()["status"] == "healthy"
    q = spark.createDataFrame([(3,)], "missing_total long")
    r = MO.status(summ, q).first()
    assert r["status"] == "warning" and r["alerts"] == ["Found 3 missing values"]
