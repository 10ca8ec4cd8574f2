"""Exploratory aggregates: profiles, counts, group means, histograms,
densities, correlations and regression lines.

Wide statistics are computed in one aggregate (one scan, partial
aggregation before the shuffle); per-column results are unpivoted after
the aggregate, so the raw rows are never exploded when it can be
avoided. Global statistics reach row-level expressions as scalar
subqueries (computed once, no join).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.functions import scalar as X
from demandspark.operators import selection as SEL
from demandspark.operators.projection import numeric_columns, string_columns


def with_stats(df: DataFrame, exprs: dict[str, Column], source: DataFrame | None = None,
               name: str = "__st") -> tuple[DataFrame, dict[str, Column]]:
    """Attach global statistics of ``source`` (default ``df``) to every row.

    The statistics are one struct computed once as a scalar subquery
    (partial + final aggregate, no join, nothing collected). It is added
    as column ``name`` in a single projection, so later references are
    attribute reads and the subquery plan appears once. Callers drop
    ``name`` when done. Returns the DataFrame and a column per statistic.
    """
    src = df if source is None else source
    s = src.agg(F.struct(*[e.alias(k) for k, e in exprs.items()]).alias("s")).scalar()
    return df.withColumn(name, s), {k: F.col(name)[k] for k in exprs}


def long_form(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = (),
              name: str = "column", value: str = "value", dtype: str = "double") -> DataFrame:
    """Unpivot ``cols`` to (ids..., column, value)."""
    cast = df.select(*ids, *[F.col(c).cast(dtype).alias(c) for c in cols])
    return cast.unpivot(list(ids), list(cols), name, value)


# --- counts and profiles ----------------------------------------------------------

def schema_info(df: DataFrame) -> DataFrame:
    """Per column: dtype, non-null count, table rows; one aggregate."""
    aggs = [F.count(F.col(c)).alias(c) for c in df.columns] + [F.count(F.lit(1)).alias("__rows")]
    one = df.agg(*aggs)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    stack = F.inline(F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"),
                                        F.lit(types[c]).alias("dtype"), F.col(c).alias("non_null"))
                               for i, c in enumerate(df.columns)]))
    return one.select(stack, F.col("__rows").alias("rows"))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: NULL (and NaN for floating columns) count."""
    cols = list(cols or df.columns)
    fl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    aggs = [F.count_if(F.col(c).isNull() | (F.isnan(c) if c in fl else F.lit(False))).alias(c) for c in cols]
    one = df.agg(*aggs)
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing"))
                                         for c in cols])))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first occurrence of each full row (NULLs compare
    equal). Grouping pre-aggregates map-side, so a row repeated a billion
    times is one partial-count row per task."""
    g = df.groupBy(*df.columns).count()
    return g.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Frequency of each value per column (column, value, count)."""
    lf = long_form(df, cols, dtype="string")
    return lf.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
              exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """(column, prob, quantile) of the finite values with linear interpolation
    between order statistics (pandas / ``quantile_cont``).

    ``exact`` selects the values at the ranks by narrowing (``selection``):
    no value is sorted or shuffled; otherwise ``percentile_approx``.
    """
    if not exact:
        aggs = [F.percentile_approx(finite(c), list(probs), accuracy).alias(c) for c in cols]
        one = df.agg(*aggs)
        return one.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.lit(float(p)).alias("prob"),
                     F.col(c)[i].cast("double").alias("quantile"))
            for c in cols for i, p in enumerate(probs)])))
    counts = df.agg(*[F.count(finite(c)).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    found = exact_quantiles(df, [finite(c) for c in cols], list(counts), probs)
    rows = [(c, float(p), q) for c, own in zip(cols, found) for p, q in zip(probs, own) if q is not None]
    return df.sparkSession.createDataFrame(rows, "column string, prob double, quantile double")


def exact_quantiles(df: DataFrame, values: Sequence[Column], counts: Sequence[int], probs: Sequence[float]) -> list[list[float | None]]:
    ranks = [[r for p in probs for r in SEL.quantile_ranks(n, p)] if n else [] for n in counts]
    at = SEL.select_ranks(df, values, ranks)
    return [[SEL.interpolated(n, p, own) for p in probs] for n, own in zip(counts, at)]


NUMERIC_PROFILE = ("count", "mean", "std", "min", "q25", "q50", "q75", "max")


def numeric_profiles(df: DataFrame, values: dict[object, Column], exact: bool = True) -> dict[object, dict]:
    """count, mean, sample std, min, quartiles and max of each of ``values``
    (finite doubles or NULL): one aggregate, then the quartiles' ranks for all
    together. What comes to the driver is one row per value column."""
    aggs, probs = [], [0.25, 0.5, 0.75]
    for x in values.values():
        own = [F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")]
        aggs.append(F.struct(*own, *([] if exact else [F.percentile_approx(x, probs).alias("q")])).alias(f"s{len(aggs)}"))
    one = [r.asDict() for r in df.agg(*aggs).first()]
    quartiles = exact_quantiles(df, list(values.values()), [r["count"] for r in one], probs) if exact else [r.pop("q") or [None] * 3 for r in one]
    return {name: {**r, **dict(zip(("q25", "q50", "q75"), q))} for name, r, q in zip(values, one, quartiles)}


def describe(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """pandas ``describe(include='all')`` transposed: one row per column.

    Numeric: count, mean, std (sample), min, 25%, 50%, 75%, max of the
    finite values (a column without any has count 0 and NULLs). Text: count,
    unique, top (most frequent; ties -> smallest), freq.
    """
    cols = list(cols or df.columns)
    num = [c for c in numeric_columns(df) if c in cols]
    txt = [c for c in string_columns(df) if c in cols]
    parts = []
    if num:
        found = numeric_profiles(df, {c: finite(c) for c in num}, exact)
        rows = [(c, *(found[c][k] for k in NUMERIC_PROFILE)) for c in num]
        schema = "column string, count long, " + ", ".join(f"{k} double" for k in NUMERIC_PROFILE[1:])
        parts.append(df.sparkSession.createDataFrame(rows, schema).select(
            "column", "count", F.lit(None).cast("bigint").alias("unique"),
            F.lit(None).cast("string").alias("top"), F.lit(None).cast("bigint").alias("freq"),
            "mean", "std", "min", "q25", "q50", "q75", "max"))
    if txt:
        vc = value_counts(df, txt).where(F.col("value").isNotNull())
        # top: highest count, ties -> smallest value; min_by aggregates
        # partially, so a column with billions of distinct values is fine.
        tp = vc.groupBy("column").agg(
            F.sum("count").alias("count"), F.count(F.lit(1)).alias("unique"),
            F.min_by(F.struct("value", "count"), F.struct(-F.col("count"), F.col("value"))).alias("t"))
        txtp = tp.select(
            "column", "count", "unique", F.col("t.value").alias("top"), F.col("t.count").alias("freq"),
            *[F.lit(None).cast("double").alias(n) for n in ("mean", "std", "min", "q25", "q50", "q75", "max")])
        parts.append(txtp)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- group means --------------------------------------------------------------------

def group_mean(df: DataFrame, by: Sequence[str], target: str, places: int | None = None) -> DataFrame:
    avg = F.avg(target)
    if places is not None:
        avg = F.round(avg, places)
    return df.groupBy(*by).agg(avg.alias(f"avg_{target}" if places is None else "avg_count"),
                               F.count(F.lit(1)).alias("n"))


def grouping_set_means(df: DataFrame, sets: Sequence[Sequence[str]], target: str) -> DataFrame:
    """All group means in one scan: Expand + one shuffle, ``gid`` tags the set."""
    keys = []
    for s in sets:
        for k in s:
            if k not in keys:
                keys.append(k)
    return df.groupingSets([list(s) for s in sets], *keys).agg(
        F.grouping_id().alias("gid"), F.avg(target).alias("avg_count"), F.count(F.lit(1)).alias("n"))


# --- binning, histograms, densities ----------------------------------------------------

def finite(x: Column | str) -> Column:
    """The value as a double, NULL where it is NULL, NaN or infinite."""
    x = (F.col(x) if isinstance(x, str) else x).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def equal_width_bins(df: DataFrame, col: str, n: int, out: str = "bin") -> DataFrame:
    """Right-closed equal-width bins over the column's [min, max]; the
    bounds come from one scalar subquery."""
    x = finite(col)
    d, st = with_stats(df, {"mn": F.min(x), "mx": F.max(x)})
    return d.withColumn(out, X.equal_width_bin(x, st["mn"], st["mx"], n)).drop("__st")


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """(column, bin, lo, hi, count) with numpy-style equal-width bins
    (left-closed, last bin closed) over the finite values; NULL, NaN and
    infinite values are in no bin. Bin ids are computed on the wide row
    (bounds from one scalar subquery), then only the small ints unpivot."""
    stats = {}
    for c in cols:
        stats[f"{c}__mn"] = F.min(finite(c))
        stats[f"{c}__mx"] = F.max(finite(c))
    d, st = with_stats(df, stats)
    bcols = {}
    for c in cols:
        mn, mx = st[f"{c}__mn"], st[f"{c}__mx"]
        x = finite(c)
        raw = F.floor((x - mn) / (mx - mn) * F.lit(float(bins)))
        b = F.when(mx == mn, F.lit(0)).otherwise(F.least(raw.cast("int"), F.lit(bins - 1)))
        bcols[c] = F.when(x.isNotNull(), b)
    wide = d.select(*[v.cast("int").alias(k) for k, v in bcols.items()])
    lf = wide.unpivot([], list(cols), "column", "bin").where(F.col("bin").isNotNull())
    counts, st = with_stats(lf.groupBy("column", "bin").agg(F.count(F.lit(1)).alias("count")), stats, source=df)
    mn = F.coalesce(*[F.when(F.col("column") == c, st[f"{c}__mn"]) for c in cols])
    mx = F.coalesce(*[F.when(F.col("column") == c, st[f"{c}__mx"]) for c in cols])
    w = (mx - mn) / F.lit(float(bins))
    return counts.select("column", "bin", (mn + F.col("bin") * w).alias("lo"),
                         (mn + (F.col("bin") + 1) * w).alias("hi"), "count")


def density(df: DataFrame, cols: Sequence[str], bins: int = 200, grid: int = 100) -> DataFrame:
    """Gaussian kernel density per column on a grid of ``grid`` points over
    [min, max], smoothed from a ``bins``-bin histogram (never rows x grid).
    Width: Silverman's rule 1.06 * std * n^(-1/5)."""
    h = histogram(df, cols, bins)
    aggs = {}
    for c in cols:
        aggs[f"{c}__sd"] = F.stddev_samp(finite(c))
        aggs[f"{c}__n"] = F.count(finite(c))
    h, st = with_stats(h, aggs, source=df)
    sd = F.coalesce(*[F.when(F.col("column") == c, st[f"{c}__sd"]) for c in cols])
    n = F.coalesce(*[F.when(F.col("column") == c, st[f"{c}__n"]) for c in cols])
    bw = F.lit(1.06) * sd * F.pow(n.cast("double"), F.lit(-0.2))
    # Grid bounds are the histogram's outer edges: per column, min lo / max hi.
    wcol = Window.partitionBy("column")
    h = h.withColumns({"g_lo": F.min("lo").over(wcol), "g_hi": F.max("hi").over(wcol),
                       "center": (F.col("lo") + F.col("hi")) / 2, "bw": bw, "nn": n})
    g = h.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    x = F.col("g_lo") + F.col("g") * (F.col("g_hi") - F.col("g_lo")) / F.lit(float(grid - 1))
    z = (x - F.col("center")) / F.col("bw")
    contrib = F.col("count") * F.exp(F.lit(-0.5) * z * z) / (F.col("nn") * F.col("bw") * F.lit(math.sqrt(2 * math.pi)))
    return g.groupBy("column", "g").agg(F.first(x).alias("x"), F.sum(contrib).alias("density"))


# --- correlation and regression lines ----------------------------------------------------

def correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson matrix in long form (x, y, corr), each pair over the rows
    where both values are finite.

    Two passes, both plain sums: the k means (one scalar subquery), then per
    pair the count and the first and second moments of the values less those
    means, in one aggregate. Centring keeps the moments numerically stable,
    and plain sums aggregate far faster than k(k+1)/2 separate ``corr``
    buffers. A constant column gives NULL."""
    cols = list(cols)
    x = {c: finite(c) for c in cols}
    d, st = with_stats(df, {c: F.avg(x[c]) for c in cols})
    cen = d.select(*[(x[c] - st[c]).alias(c) for c in cols])
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    sums = []
    for i, (a, b) in enumerate(pairs):
        u, v = F.col(a), F.col(b)
        both = u.isNotNull() & v.isNotNull()
        for name, e in (("n", F.lit(1.0)), ("a", u), ("b", v), ("ab", u * v), ("aa", u * u), ("bb", v * v)):
            sums.append(F.sum(F.when(both, e)).alias(f"{name}{i}"))
    one = cen.agg(*sums)
    entries = []
    for i, (a, b) in enumerate(pairs):
        n, sa, sb, ab, aa, bb = (F.col(f"{name}{i}") for name in ("n", "a", "b", "ab", "aa", "bb"))
        spread = F.sqrt((aa - F.try_divide(sa * sa, n)) * (bb - F.try_divide(sb * sb, n)))
        r = F.try_divide(ab - F.try_divide(sa * sb, n), spread)
        entries.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), r.alias("corr")))
        if a != b:
            entries.append(F.struct(F.lit(b).alias("x"), F.lit(a).alias("y"), r.alias("corr")))
    return one.select(F.inline(F.array(*entries)))


def regression_lines(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """Least-squares line of ``target`` on each column: (column, slope,
    intercept, r2) over the rows where both are finite.

    Centred moments in two plain-sum passes (pair means as one scalar
    subquery, then Sxx, Syy, Sxy per column), with the ``regr_*`` rules:
    no x variance -> NULL; no y variance -> r2 = 1."""
    cols = list(cols)
    y = finite(target)
    x = {c: finite(c) for c in cols}
    both = {c: x[c].isNotNull() & y.isNotNull() for c in cols}
    means = {}
    for c in cols:
        means[f"{c}__mx"] = F.avg(F.when(both[c], x[c]))
        means[f"{c}__my"] = F.avg(F.when(both[c], y))
    d, st = with_stats(df, means)
    sums = []
    for c in cols:
        dx = F.when(both[c], x[c] - st[f"{c}__mx"])
        dy = F.when(both[c], y - st[f"{c}__my"])
        sums.append(F.struct(F.sum(dx * dx).alias("sxx"), F.sum(dy * dy).alias("syy"), F.sum(dx * dy).alias("sxy"),
                             F.first(st[f"{c}__mx"]).alias("mx"), F.first(st[f"{c}__my"]).alias("my")).alias(c))
    one = d.agg(*sums)
    long = one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`.*")) for c in cols])))
    slope = F.when(F.col("sxx") != 0, F.col("sxy") / F.col("sxx"))
    r2 = (F.when(F.col("sxx") == 0, F.lit(None).cast("double")).when(F.col("syy") == 0, F.lit(1.0))
          .otherwise(F.col("sxy") * F.col("sxy") / (F.col("sxx") * F.col("syy"))))
    return long.select("column", slope.alias("slope"), (F.col("my") - slope * F.col("mx")).alias("intercept"),
                       r2.alias("r2"))


def target_range(df: DataFrame, split: str, target: str) -> DataFrame:
    return df.groupBy(split).agg(F.min(target).alias("min"), F.max(target).alias("max"),
                                 F.count(F.lit(1)).alias("n"))


def error_by_range(df: DataFrame, y: str, yhat: str, bins: int = 10) -> DataFrame:
    """Mean absolute error per equal-width bin of the actual value, over the
    rows where the actual and the predicted value are finite."""
    b = equal_width_bins(df.where(finite(y).isNotNull() & finite(yhat).isNotNull()), y, bins, out="bin")
    return b.groupBy("bin").agg(F.avg(F.abs(F.col(y) - F.col(yhat))).alias("mean_abs_error"),
                                F.count(F.lit(1)).alias("n"))


def summary_stats(results: DataFrame, r2: str = "test_r2", rmse: str = "test_rmse") -> DataFrame:
    return results.agg(F.avg(r2).alias("avg_r2"), F.max(r2).alias("best_r2"),
                       F.avg(rmse).alias("avg_rmse"), F.count(F.lit(1)).alias("models"))
