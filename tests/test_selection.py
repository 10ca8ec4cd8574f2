"""Selection by narrowing, bracketed drift statistics and two-step splits against brute force."""

import hashlib
import math
import random
import struct
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandspark.operators import drift as DR
from demandspark.operators import monitor as MO
from demandspark.operators import profile as P
from demandspark.operators import selection as SEL
from demandspark.operators import split as SP

INF, NAN = float("inf"), float("nan")


def test_images_are_the_bits_of_every_exponent(spark):
    values = [0.0, 5e-324, 2.2250738585072009e-308, 1.7976931348623157e308]
    for e in range(-1074, 1024):
        values += [v for m in (1.0, np.nextafter(1.0, 2), 1.5, np.nextafter(2.0, 1)) if math.isfinite(v := math.ldexp(m, e))]
    values += [-v for v in values]
    for r in SEL.with_image(spark.createDataFrame([(float(v),) for v in values], "x double"), "x", "v").collect():
        bits = struct.unpack("<q", struct.pack("<d", abs(r.x)))[0]
        assert r.v == (-bits if r.x < 0 else bits) and SEL.value_of(r.v) == r.x


def test_selected_ranks(spark):
    rng = np.random.default_rng(2)
    columns = [rng.normal(size=3000), rng.normal(size=3000) * 10.0 ** rng.integers(-300, 300, 3000), np.round(rng.normal(size=3000), 1), np.full(3000, 7.25), 1 + rng.random(3000) * 1e-9]
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*columns)], "a double, b double, c double, d double, e double")
    ranks = [[0, 1, 749, 1500, 2999], [0, 10, 2000, 2999], [0, 1000, 1001], [0, 2999], [1, 1499, 1500]]
    for gather in (10_000, 1):  # with cells gathered early, and narrowed to single values
        got = SEL.select_ranks(df, [F.col(c) for c in "abcde"], ranks, gather)
        assert got == [{r: float(np.sort(x)[r]) for r in own} for x, own in zip(columns, ranks)]


def test_profiles_leave_out_what_is_not_finite(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=501)
    rows = [(float(v), None) for v in x] + [(INF, NAN), (-INF, None), (NAN, INF), (None, None)]
    df = spark.createDataFrame(rows, "x double, y double")
    d = {r.column: r for r in P.describe(df).collect()}
    assert d["x"]["count"] == 501 and d["x"].q25 == pytest.approx(np.quantile(x, 0.25), abs=1e-12) and d["x"]["std"] == pytest.approx(np.std(x, ddof=1))
    assert d["x"].max == x.max() and d["y"]["count"] == 0 and d["y"].q50 is None and d["y"]["mean"] is None
    assert P.quantiles(df, ["y"], [0.5]).count() == 0
    s = {(r.dataset, r.column): r for r in MO.column_summary(df, df.limit(0), ["x", "y"]).collect()}
    assert s["reference", "x"].q75 == d["x"].q75 and s["current", "x"]["count"] == 0 and s["current", "x"].q25 is None


def test_one_odd_value_changes_no_line_or_bin(spark):
    rows = [(float(i), 2.0 * i + 1, 2.0 * i + 2) for i in range(50)]
    odd = rows + [(INF, 1.0, 2.0), (1.0, NAN, 1.0), (NAN, 2.0, 3.0), (3.0, -INF, 4.0), (INF, 4.0, INF)]
    clean, dirty = (spark.createDataFrame(r, "x double, y double, yhat double") for r in (rows, odd))
    line = P.regression_lines(dirty, "y", ["x"]).first()
    assert line.slope == pytest.approx(2) and line.intercept == pytest.approx(1) and line.r2 == pytest.approx(1)
    ranges = {r.bin: r.mean_abs_error for r in P.error_by_range(dirty, "y", "yhat").collect()}
    assert set(ranges.values()) == {1.0} and P.error_by_range(clean, "y", "yhat").count() == len(ranges)


def brute_drift(a, b):
    a, b = (np.sort([v for v in x if v is not None and math.isfinite(v)]) for x in (a, b))
    grid = np.union1d(a, b)
    gap = np.abs(np.searchsorted(a, grid, side="right") / len(a) - np.searchsorted(b, grid, side="right") / len(b))
    return gap.max(), (gap[:-1] * np.diff(grid)).sum()


@pytest.mark.parametrize("gather", [50_000, 3])
def test_drift_of_many_shapes(spark, gather):
    rng = np.random.default_rng(4)
    n, m = 900, 700
    shapes = {"same": (rng.normal(size=n), rng.normal(size=m)), "shift": (rng.normal(size=n), rng.normal(0.5, 1, m)), "scale": (rng.normal(size=n), rng.normal(0, 3, m)), "apart": (rng.random(n), 5 + rng.random(m)),
              "tight": (1 + rng.random(n) * 1e-7, 1 + rng.random(m) * 1.1e-7), "coarse": (np.round(rng.normal(size=n)), np.round(rng.normal(0.2, 1, m))), "heavy": (rng.standard_cauchy(n) ** 3, rng.standard_cauchy(m) ** 3), "one": (np.full(n, 2.5), np.full(m, 2.5))}
    names = list(shapes)
    for x in names:
        shapes[x] = ([float(v) for v in shapes[x][0]] + [INF, NAN, None], [float(v) for v in shapes[x][1]] + [-INF, None])
    a, b = (spark.createDataFrame(list(zip(*(shapes[x][i] for x in names))), ", ".join(f"{x} double" for x in names)) for i in (0, 1))
    bins = []
    for size in (None, 10_000):  # by cells, and value by value
        found = DR.NumericDrift(DR.numeric_rows(a, b, names), names, size=size, gather=gather)
        bins.append(sorted(map(tuple, found.binned().collect())))
        for x, r in zip(names, found.solve()):
            ks, area = brute_drift(*shapes[x])
            assert r["statistic"] == pytest.approx(ks, abs=1e-12), x
            assert r["wasserstein"] == pytest.approx(area, rel=1e-9, abs=1e-12), x
            assert (r["n_ref"], r["n_cur"]) == (n, m)
    assert bins[0] == bins[1]


def test_smooth_drift_looks_into_few_cells(spark):
    """What is looked into hardly grows with the table when the distributions differ smoothly."""
    seen = []
    for n in (20_000, 200_000):
        ref = spark.range(n).select(((F.col("id") * 7919 % n) / n).alias("v"))
        cur = ref.select((F.col("v") * 0.9 + 0.15).alias("v"))
        d = DR.NumericDrift(DR.numeric_rows(ref, cur, ["v"]), ["v"])
        r = d.solve()[0]
        assert r["wasserstein"] == pytest.approx(brute_drift(*([x.v for x in t.collect()] for t in (ref, cur)))[1], rel=1e-9)
        seen.append(sum(d.opened))
    assert seen[0] < 0.05 * 40_000 and seen[1] < 0.05 * 400_000


def test_an_infinite_value_raises_no_drift(spark):
    same = spark.range(1000).select(F.lit(3.0).alias("v"), F.lit("a").alias("c"))
    odd = same.union(spark.createDataFrame([(INF, "a"), (NAN, "a")], "v double, c string"))
    for ref, cur in ((same, odd), (odd, same), (odd, odd)):
        r = {x.column: x for x in DR.drift_table(ref, cur, ["v"], ["c"]).collect()}["v"]
        assert (r.statistic, r.wasserstein_norm, r.drifted) == (0.0, 0.0, False) and r.js_distance == 0


def test_chi_square_p_values(spark):
    t = spark.createDataFrame([(0.5, 0.1), (0.5, 3.0), (1.0, 2.0), (1.5, 8.0), (4.0, 3.9), (50.0, 40.0), (500.0, 560.0), (3.0, 0.0)], "a double, x double")
    got = [r.q for r in t.select(DR.upper_gamma_share(F.col("a"), F.col("x")).alias("q")).collect()]
    # erfc, exp and Poisson sums
    want = [math.erfc(math.sqrt(0.1)), math.erfc(math.sqrt(3.0)), math.exp(-2), math.erfc(math.sqrt(8)) + math.exp(-8) * math.sqrt(8) / math.gamma(1.5)]
    want += [sum(math.exp(-x + k * math.log(x) - math.lgamma(k + 1)) for k in range(a)) for a, x in ((4, 3.9), (50, 40.0), (500, 560.0))] + [1.0]
    assert got == pytest.approx(want, abs=1e-11)
    one = spark.createDataFrame([("a", None), ("a", "x")], "c string, d string")
    r = {x.column: x for x in DR.chi_square_p_values(one, one.limit(0), ["c", "d"]).collect()}
    assert r["c"].p_value is None and r["c"].dof == 0


def brute_split(rows, test, val, bins=5, seed=42):
    def half(x):
        return int(Decimal(repr(x)).quantize(Decimal(1), ROUND_HALF_UP))

    def first(rows, frac):
        known = [y for _, y in rows if y is not None and math.isfinite(y)]
        lo, hi = (min(known), max(known)) if known else (0, 0)
        strata = {}
        for k, y in rows:
            s = -1 if y is None or not math.isfinite(y) else sum(y > lo + i * ((hi - lo) / bins) for i in range(1, bins))
            strata.setdefault(s, []).append((hashlib.md5(f"{k}|{seed}".encode()).hexdigest(), k))
        gone = set()
        for own in strata.values():
            own.sort()
            r = half(len(own) * frac)
            if r:
                gone |= {k for h, k in own if (h, k) <= own[r - 1]}
        return gone

    # a key's flag hangs on its stratum, too: these keys have one stratum each
    out = first(rows, test)
    rest = [(k, y) for k, y in rows if k not in out]
    more = first(rest, val)
    return {k: "test" if k in out else "val" if k in more else "train" for k, _ in rows}


@pytest.mark.parametrize("gather", [20_000, 5])
@pytest.mark.parametrize("kind", ["even", "extremes", "repeats", "nulls", "few"])
def test_two_step_split(spark, monkeypatch, kind, gather):
    monkeypatch.setattr(SP, "GATHER", gather)
    monkeypatch.setattr(SP, "DIGITS", 1)  # coarse cells, so that many rows share one
    rng = random.Random(kind)
    rows = [(k, float(rng.randint(0, 400))) for k in rng.sample(range(10_000), 6 if kind == "few" else 1500)]
    if kind == "extremes":  # the largest target is a single row that is held out
        rows = [(k, y / 10 if i else 1000.0) for i, (k, y) in enumerate(sorted(rows, key=lambda r: hashlib.md5(f"{r[0]}|42".encode()).hexdigest()))]
        rows = rows[:1] * 1 + [(k, 900.0 if 5 < i < 40 else y) for i, (k, y) in enumerate(rows[1:])]
    if kind == "repeats":
        rows += [r for r in rows[::3] for _ in range(rng.randint(1, 30))]
    if kind == "nulls":
        rows = [(k, None if i % 4 == 0 else INF if i % 9 == 0 else y) for i, (k, y) in enumerate(rows)]
    df = spark.createDataFrame(rows, "k long, y double")
    got = {r.k: r.split for r in SP.stratified(df, "k", "y", 0.2, 0.25).collect()}
    assert got == brute_split(rows, 0.2, 0.25)
    held = {r.k: r.split for r in SP.holdout(df, "k", "y", 0.3).collect()}
    assert held == {k: "test" if s == "test" else "train" for k, s in brute_split(rows, 0.3, 0.0).items()}


def test_reference_state_equals_the_reference(spark, tmp_path):
    rng = np.random.default_rng(9)
    ref = spark.createDataFrame([(float(v), str(c)) for v, c in zip(np.round(rng.normal(size=600), 2), rng.integers(0, 5, 600))] + [(INF, None), (None, "x")], "v double, c string")
    state = DR.ReferenceState(ref, ["v"], ["c"], str(tmp_path / "state"))
    for shift in (0.0, 0.4):
        cur = spark.createDataFrame([(float(v), str(c)) for v, c in zip(rng.normal(shift, 1, 200), rng.integers(1, 7, 200))] + [(NAN, "y")], "v double, c string")
        got, want = (sorted(t.collect()) for t in (state.drift_table(cur), DR.drift_table(ref, cur, ["v"], ["c"])))
        for a, b in zip(got, want, strict=True):
            assert a.column == b.column and a.drifted == b.drifted
            assert a[2:7] == pytest.approx(b[2:7], abs=1e-12, nan_ok=True) if a.kind == "numeric" else (a.statistic, a.js_distance, a.psi) == pytest.approx((b.statistic, b.js_distance, b.psi), abs=1e-12)
    empty = {r.column: r for r in state.drift_table(ref.limit(0)).collect()}
    assert not empty["v"].drifted and empty["v"].statistic is None
