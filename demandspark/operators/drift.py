"""Distribution drift between a reference and a current table.

All numeric columns are tested together from counts by value prefix (no
value is sorted or shuffled, but those of the few cells that decide), all
categorical ones from counts by value. Infinite values and NaN count as
missing.

Statistics (published bases):
* two-sample Kolmogorov-Smirnov D = max |F_ref - F_cur| and its
  asymptotic p-value 2 * sum_k (-1)^(k-1) exp(-2 k^2 lambda^2),
  lambda = sqrt(n1 n2 / (n1 + n2)) * D (Smirnov 1948);
* Pearson chi-square on the (value x dataset) contingency table;
* Wasserstein-1 = integral |F_ref - F_cur| dx (Vallender 1974), divided
  by the reference standard deviation;
* Jensen-Shannon distance (Lin 1991) and the population stability index
  on binned shares (shares floored at 1e-4).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandspark import schema as S
from demandspark.operators import selection as SEL
from demandspark.operators.profile import finite
from demandspark.session import checkpoint_dir

TAG = "dataset"
REF, CUR = "reference", "current"
FLOOR = 1e-4
KS_TERMS = 100
GAMMA_STEPS = 200
DIRECT = 5_000_000  # values that are counted one by one at once
GATHER = 1_000_000  # rows of a cell that are looked at value by value
# Lanczos' coefficients for g = 7.
LANCZOS_G = 7
LANCZOS = (0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
           12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7)


def tagged_union(reference: DataFrame, current: DataFrame, tag: str = TAG) -> DataFrame:
    return reference.withColumn(tag, F.lit(REF)).unionByName(
        current.withColumn(tag, F.lit(CUR)), allowMissingColumns=True)


def _counts(union: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, n_ref, n_cur) of text values, without NULL."""
    cast = union.select(F.col(TAG), *[F.col(c).cast("string").alias(c) for c in cols])
    lf = cast.unpivot([TAG], list(cols), "column", "value").where(F.col("value").isNotNull())
    return lf.groupBy("column", "value").agg(
        F.count_if(F.col(TAG) == REF).alias("n_ref"), F.count_if(F.col(TAG) == CUR).alias("n_cur"))


def _totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("column").agg(F.sum("n_ref").alias("tot_ref"), F.sum("n_cur").alias("tot_cur"))


def ks_p_value(d: Column, n1: Column, n2: Column) -> Column:
    lam = F.sqrt(F.try_divide(n1 * n2, n1 + n2)) * d
    series = F.aggregate(F.sequence(F.lit(1), F.lit(KS_TERMS)), F.lit(0.0),
                         lambda acc, k: acc + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
                         * F.exp(F.lit(-2.0) * k * k * lam * lam))
    p = F.least(F.greatest(F.lit(2.0) * series, F.lit(0.0)), F.lit(1.0))
    return F.when(lam < 0.2, F.lit(1.0)).when(lam.isNotNull(), p)


def side_rows(df: DataFrame, cols: Sequence[str], side: str) -> DataFrame:
    """(c, x, n_ref, n_cur) of one side: each finite value once, c its column's position in ``cols``."""
    rows = df.select(F.posexplode(F.array(*[finite(c) for c in cols])).alias("c", "x")).where(F.col("x").isNotNull())
    return rows.select("c", "x", F.lit(int(side == REF)).cast("long").alias("n_ref"), F.lit(int(side == CUR)).cast("long").alias("n_cur"))


def numeric_rows(reference: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``side_rows`` of both."""
    return side_rows(reference, cols, REF).unionByName(side_rows(current, cols, CUR))


def value_counts(rows: DataFrame) -> DataFrame:
    """The same with one row per distinct value."""
    return rows.groupBy("c", "x").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))


class NumericDrift:
    """KS, Wasserstein, moments and binned counts of numeric columns from cells.

    Values are counted by image prefix (``selection.with_image``), so a cell holds
    neighbouring values and the cells' running counts give D = F_ref - F_cur at
    every cell border. Inside a cell D rises by at most the cell's reference
    share and falls by at most its current share. So the cell can hold a larger
    |D| than the borders only if these bounds say so, and where D cannot change
    its sign the area under |D| follows from the cell's sums of values. Only the
    other cells are looked into: narrowed by longer prefixes while they have
    more than GATHER rows, then value by value.

    ``rows`` (c, x, n_ref, n_cur) are scanned for bounds, for the cells, and
    once for each look into open cells. Where ``size``, the number of values, is
    known to be small (DIRECT), every value is a cell from the start, and one
    scan does: the results are the same. What comes to the driver is one row
    per column.
    """

    def __init__(self, rows: DataFrame, names: Sequence[str], bins: int = 10, size: int | None = None, gather: int = GATHER):
        self.rows, self.names, self.gather = rows, list(names), gather
        self.spark = rows.sparkSession
        checkpoint_dir(self.spark)
        x, direct = F.col("x"), size is not None and size <= DIRECT
        source, n_ref = rows, F.col("n_ref")
        if direct:
            source = self._counted(SEL.with_image(rows, "x", "v").withColumn("p", F.col("v")), "c", "p").withColumn("x", F.col("lo")).checkpoint(eager=True)
        found = {r["c"]: r for r in source.groupBy("c").agg(
            F.min(x).alias("mn"), F.max(x).alias("mx"), F.sum("n_ref").alias("nr"), F.sum("n_cur").alias("nc"), F.sum(n_ref * x).alias("s")).collect()}
        none = dict.fromkeys(("mn", "mx", "nr", "nc", "s"))
        self.known = [found[c].asDict() if c in found else dict(none) for c in range(len(self.names))]
        # one row per column; equal bounds make one bin
        per = [(c, float(k["mn"]), float(k["mx"] - k["mn"]) or 1.0, k["s"] / k["nr"] if k["nr"] else 0.0) for c, k in enumerate(self.known) if k["mn"] is not None]
        told = F.broadcast(self.spark.createDataFrame(per, "c int, mn double, width double, mean double"))
        placed = (source if direct else SEL.with_image(rows, "x", "v").withColumn("p", SEL.prefix("v", SEL.BITS[0]))).join(told, "c")
        raw = F.least(F.floor((x - F.col("mn")) / F.col("width") * F.lit(float(bins))), F.lit(bins - 1)).cast("int")
        dev = x - F.col("mean")
        placed = placed.withColumns({"bin": raw, "ss": n_ref * dev * dev})
        self.cells = placed if direct else self._counted(placed, "c", "p", "bin", ss=F.sum("ss")).checkpoint(eager=True)

    def _of(self, values: Sequence[float | None]) -> Column:
        """The value of a row's column."""
        return F.element_at(F.array(*[F.lit(v).cast("double") for v in values]), F.col("c") + 1)

    @staticmethod
    def _counted(rows: DataFrame, *keys: str, **more: Column) -> DataFrame:
        x = F.col("x")
        return rows.groupBy(*keys).agg(
            F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"), F.sum(F.col("n_ref") * x).alias("s_ref"), F.sum(F.col("n_cur") * x).alias("s_cur"),
            F.min(x).alias("lo"), F.max(x).alias("hi"), *[e.alias(k) for k, e in more.items()])

    def binned(self) -> DataFrame:
        """(column, value, n_ref, n_cur): counts of equal-width bins over [min, max]."""
        names = F.array(*[F.lit(n) for n in self.names])
        return self.cells.groupBy(F.element_at(names, F.col("c") + 1).alias("column"), F.col("bin").cast("string").alias("value")).agg(
            F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))

    def _told(self, cells: DataFrame, group: list[str], key: str, best: list[float]) -> DataFrame:
        """Cells (with what stands left of their group, and whether it wants the area) and what their borders tell."""
        nr, nc = (self._of([k[n] for k in self.known]) for n in ("nr", "nc"))
        w = Window.partitionBy(*group).orderBy(key)
        upto = w.rowsBetween(Window.unboundedPreceding, 0)
        t = cells.withColumns({"to_ref": F.col("left_ref") + F.sum("n_ref").over(upto), "to_cur": F.col("left_cur") + F.sum("n_cur").over(upto), "next": F.lead("lo").over(w)})
        t = t.withColumns({"right": F.try_divide("to_ref", nr) - F.try_divide("to_cur", nc),
                           "left": F.try_divide(F.col("to_ref") - F.col("n_ref"), nr) - F.try_divide(F.col("to_cur") - F.col("n_cur"), nc)})
        up, down = F.col("left") + F.try_divide("n_ref", nr), F.col("left") - F.try_divide("n_cur", nc)
        one, same_sign = F.col("lo") == F.col("hi"), (down >= 0) | (up <= 0)
        held = F.try_divide(F.col("n_ref") * F.col("hi") - F.col("s_ref"), nr) - F.try_divide(F.col("n_cur") * F.col("hi") - F.col("s_cur"), nc)
        inside = F.abs(F.col("left") * (F.col("hi") - F.col("lo")) + held)
        gap = F.coalesce(F.abs("right") * (F.col("next") - F.col("hi")), F.lit(0.0))
        most = F.greatest(F.max(F.abs("right")).over(Window.partitionBy("c")), self._of(best))
        t = t.withColumns({"ks": F.abs("right"), "area": F.when(F.col("wants"), gap + F.when(~one & same_sign, inside).otherwise(0.0)).otherwise(0.0),
                           "unknown": F.col("wants") & ~one & ~same_sign})
        return t.withColumn("open", ~one & (F.col("unknown") | (F.greatest(up, -down) > most)))

    def solve(self) -> list[dict]:
        """Per column: statistic, wasserstein, ss (of the reference), n_ref, n_cur; None without values on both sides."""
        both = [c for c, k in enumerate(self.known) if k["nr"] and k["nc"]]
        ks, area = [0.0] * len(self.names), [0.0] * len(self.names)
        merged = self.cells.where(F.col("c").isin(both)).groupBy("c", "p").agg(
            *[F.sum(n).alias(n) for n in ("n_ref", "n_cur", "s_ref", "s_cur", "ss")], F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        zero = F.lit(0).cast("long")
        cells, group, key = merged.withColumns({"left_ref": zero, "left_cur": zero, "wants": F.lit(True)}), ["c"], "p"
        spread: dict[int, float] = {}
        self.opened: list[int] = []  # rows of the cells looked into, step by step
        for level, bits in enumerate(SEL.BITS):
            told = self._told(cells, group, key, ks)
            told = told.checkpoint(eager=True) if level else told  # the first cells are a small written table already
            own = F.when(F.col("open"), F.col("n_ref") + F.col("n_cur"))
            sums = told.groupBy("c").agg(F.max("ks").alias("ks"), F.sum("area").alias("area"), F.sum(own).alias("n"), F.max(own).alias("most"), *([] if level else [F.sum("ss").alias("ss")])).collect()
            spread = spread or {r["c"]: r["ss"] for r in sums}
            for r in sums:
                ks[r["c"]], area[r["c"]] = max(ks[r["c"]], r["ks"]), area[r["c"]] + r["area"]
            self.opened.append(sum(r["n"] or 0 for r in sums))
            if not self.opened[-1]:
                break
            open_ = told.where("open").select("c", F.col(key).alias("p"), (F.col("to_ref") - F.col("n_ref")).alias("left_ref"), (F.col("to_cur") - F.col("n_cur")).alias("left_cur"), F.col("unknown").alias("wants"))
            some = self.rows.where(F.col("c").isin([r["c"] for r in sums if r["n"]]))
            inside = SEL.with_image(some, "x", "v").withColumn("p", SEL.prefix("v", bits)).join(open_, ["c", "p"])
            last = level + 1 == len(SEL.BITS) - 1 or max(r["most"] or 0 for r in sums) <= self.gather
            cells = self._counted(inside.withColumn("q", F.col("v") if last else SEL.prefix(F.col("v"), SEL.BITS[level + 1])), "c", "p", "q", "left_ref", "left_cur", "wants")
            group, key = ["c", "p"], "q"
            if last:  # every cell is one value
                told = self._told(cells, group, key, ks).groupBy("c").agg(F.max("ks").alias("ks"), F.sum("area").alias("area")).collect()
                for r in told:
                    ks[r["c"]], area[r["c"]] = max(ks[r["c"]], r["ks"]), area[r["c"]] + r["area"]
                break
        return [{"statistic": ks[c], "wasserstein": area[c], "ss": spread[c], "n_ref": k["nr"], "n_cur": k["nc"]} if c in both
                else {"statistic": None, "wasserstein": None, "ss": None, "n_ref": k["nr"], "n_cur": k["nc"]} for c, k in enumerate(self.known)]

    def table(self) -> DataFrame:
        """column, kind, statistic, p_value, wasserstein_norm, n_ref, n_cur: columns without any value have no row."""
        rows = [(n, *(r[k] for k in ("statistic", "wasserstein", "ss", "n_ref", "n_cur"))) for n, r in zip(self.names, self.solve()) if r["n_ref"] is not None]
        t = self.spark.createDataFrame(rows, "column string, statistic double, wasserstein double, ss double, n_ref long, n_cur long")
        sd = F.sqrt(F.try_divide(F.col("ss"), F.col("n_ref") - 1))
        return t.select(
            "column", F.lit("numeric").alias("kind"), "statistic", ks_p_value(F.col("statistic"), F.col("n_ref"), F.col("n_cur")).alias("p_value"),
            (F.col("wasserstein") / F.when(sd == 0, F.lit(1.0)).otherwise(sd)).alias("wasserstein_norm"), "n_ref", "n_cur")


def categorical_counts(reference: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, n_ref, n_cur) of the categorical inputs, checkpointed
    (it feeds both the chi-square and the share statistics)."""
    c = _counts(tagged_union(reference.select(*cols), current.select(*cols)), cols)
    checkpoint_dir(c.sparkSession)
    return c.checkpoint(eager=True)


def numeric_drift(reference: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per numeric column: KS statistic and p-value, normalised
    Wasserstein distance; with the sample sizes."""
    return _profile(reference, current, cols).table()


def _profile(reference: DataFrame, current: DataFrame, cols: Sequence[str], bins: int = 10) -> NumericDrift:
    size = (reference.count() + current.count()) * len(cols)
    return NumericDrift(numeric_rows(reference, current, cols), cols, bins, size)


def chi_from_counts(c: DataFrame) -> DataFrame:
    tot = _totals(c)
    j = c.join(F.broadcast(tot), "column")
    n = F.col("tot_ref") + F.col("tot_cur")
    row = F.col("n_ref") + F.col("n_cur")
    e_ref = F.try_divide(row * F.col("tot_ref"), n)
    e_cur = F.try_divide(row * F.col("tot_cur"), n)
    term = F.try_divide((F.col("n_ref") - e_ref) ** 2, e_ref) + F.try_divide((F.col("n_cur") - e_cur) ** 2, e_cur)
    return j.groupBy("column").agg(
        F.lit("categorical").alias("kind"), F.sum(term).alias("statistic"),
        (F.count(F.lit(1)) - 1).alias("dof"), F.first("tot_ref").alias("n_ref"), F.first("tot_cur").alias("n_cur"))


def categorical_drift(reference: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per categorical column: Pearson chi-square statistic and degrees of
    freedom of the (value x dataset) table."""
    return chi_from_counts(categorical_counts(reference, current, cols))


def log_gamma(x: Column) -> Column:
    """ln Gamma(x), x > 0 (Lanczos 1964)."""
    total = F.lit(LANCZOS[0])
    for k, c in enumerate(LANCZOS[1:]):
        total = total + F.lit(c) / (x + k)
    t = x + LANCZOS_G - 0.5
    return F.lit(0.5 * math.log(2 * math.pi)) + (x - 0.5) * F.log(t) - t + F.log(total)


def upper_gamma_share(a: Column, x: Column) -> Column:
    """The regularised upper incomplete gamma function Q(a, x): by the series of
    1 - Q below a + 1, by the continued fraction (Lentz) above."""
    front = F.exp(a * F.log(x) - x - log_gamma(a))
    steps = F.sequence(F.lit(1), F.least(F.lit(GAMMA_STEPS) + F.ceil(10 * F.sqrt(a)), F.lit(100_000)).cast("int"))
    one = F.struct((1 / a).alias("term"), (1 / a).alias("sum"))
    series = F.aggregate(steps, one, lambda s, k: F.struct((s["term"] * x / (a + k)).alias("term"), (s["sum"] + s["term"] * x / (a + k)).alias("sum")))["sum"]
    b0 = x + 1 - a

    def lentz(s, k):
        up = -k * (k - a)
        b = x + 1 - a + 2 * k
        d, c = 1 / (up * s["d"] + b), b + up / s["c"]
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

    first = F.struct(F.lit(1e300).alias("c"), (1 / b0).alias("d"), (1 / b0).alias("h"))
    fraction = F.aggregate(steps, first, lentz)["h"]
    return F.when(x <= 0, 1.0).when(x < a + 1, F.greatest(1 - front * series, F.lit(0.0))).otherwise(front * fraction)


def chi_square_p_values(reference: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """column, statistic, dof, p_value (NULL without freedom or without values on
    a side) of the (value x dataset) table, from its counts alone."""
    t = categorical_drift(reference, current, cols)
    p = upper_gamma_share(F.col("dof") / F.lit(2.0), F.col("statistic") / 2)
    return t.select("column", F.when((F.col("dof") > 0) & F.col("statistic").isNotNull(), p).alias("p_value"), "dof", "statistic")


def _shares(c: DataFrame) -> DataFrame:
    tot = _totals(c)
    j = c.join(F.broadcast(tot), "column")
    return j.select("column", "value", F.try_divide("n_ref", "tot_ref").alias("p"), F.try_divide("n_cur", "tot_cur").alias("q"))


def _magnitudes(shares: DataFrame) -> DataFrame:
    p, q = F.col("p"), F.col("q")
    m = (p + q) / 2
    kl = (F.when(p > 0, p * F.log(p / m)).otherwise(F.lit(0.0))
          + F.when(q > 0, q * F.log(q / m)).otherwise(F.lit(0.0)))
    pf, qf = F.greatest(p, F.lit(FLOOR)), F.greatest(q, F.lit(FLOOR))
    psi = (qf - pf) * F.log(qf / pf)
    return shares.groupBy("column").agg(F.sqrt(F.greatest(F.lit(0.0), F.lit(0.5) * F.sum(kl))).alias("js_distance"),
                                        F.sum(psi).alias("psi"))


def binned_magnitudes(reference: DataFrame, current: DataFrame, numeric: Sequence[str],
                      categorical: Sequence[str], bins: int = 10) -> DataFrame:
    """Jensen-Shannon distance and PSI per column. Numeric columns use
    ``bins`` equal-width bins over the union's [min, max]."""
    parts = []
    if numeric:
        parts.append(_magnitudes(_shares(_profile(reference, current, numeric, bins).binned())))
    if categorical:
        parts.append(_magnitudes(_shares(categorical_counts(reference, current, categorical))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def drift_table(reference: DataFrame, current: DataFrame, numeric: Sequence[str],
                categorical: Sequence[str], p_threshold: float = S.DRIFT_P_THRESHOLD, magnitude_threshold: float = S.DRIFT_MAGNITUDE,
                method: str = "magnitude", bins: int = 10) -> DataFrame:
    """One row per column: kind, statistic, p_value (numeric), wasserstein_norm,
    js_distance, psi, drifted.

    Decision per column, the same at every size: by effect size (``method``
    "magnitude": Wasserstein/std of numeric columns, JS distance of
    categorical ones >= ``magnitude_threshold``), or for numeric columns by
    KS p < ``p_threshold`` ("p_value"). A column without values on one side
    has NULL statistics and isn't drifted.

    The numeric values are scanned as ``NumericDrift`` says, the categorical
    ones once (their counts serve chi-square and shares)."""
    profile = _profile(reference, current, numeric, bins) if numeric else None
    counts = categorical_counts(reference, current, categorical) if categorical else None
    return drift_from_counts(profile, counts, p_threshold, magnitude_threshold, method)


class ReferenceState:
    """The reference side's counts, written once: drift of any number of
    current tables against them, each without another look at the reference."""

    def __init__(self, reference: DataFrame, numeric: Sequence[str], categorical: Sequence[str], path: str):
        self.numeric, self.categorical, self.path = list(numeric), list(categorical), path
        checkpoint_dir(reference.sparkSession)
        value_counts(side_rows(reference, self.numeric, REF)).write.mode("overwrite").parquet(f"{path}/numeric")
        _counts(reference.select(*self.categorical).withColumn(TAG, F.lit(REF)), self.categorical).write.mode("overwrite").parquet(f"{path}/categorical")

    def drift_table(self, current: DataFrame, **rule) -> DataFrame:
        """``drift_table`` of the reference and ``current``."""
        spark, (num, cat) = current.sparkSession, (f"{self.path}/{kind}" for kind in ("numeric", "categorical"))
        # the current values are counted once as well; every later look reads the counts
        rows = spark.read.parquet(num).unionByName(value_counts(side_rows(current, self.numeric, CUR))).checkpoint(eager=True)
        size = rows.count()
        counts = spark.read.parquet(cat).unionByName(_counts(current.select(*self.categorical).withColumn(TAG, F.lit(CUR)), self.categorical))
        counts = counts.groupBy("column", "value").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur")).checkpoint(eager=True)
        return drift_from_counts(NumericDrift(rows, self.numeric, size=size), counts, **rule)


def drift_from_counts(profile: NumericDrift | None, counts: DataFrame | None,
                      p_threshold: float = S.DRIFT_P_THRESHOLD, magnitude_threshold: float = S.DRIFT_MAGNITUDE,
                      method: str = "magnitude") -> DataFrame:
    """``drift_table`` of a numeric profile and categorical counts (column, value, n_ref, n_cur)."""
    num = nmag = cat = cmag = None
    if profile is not None:
        num, nmag = profile.table(), _magnitudes(_shares(profile.binned()))
    if counts is not None:
        cat, cmag = chi_from_counts(counts), _magnitudes(_shares(counts))
    mags = [m for m in (nmag, cmag) if m is not None]
    mag = mags[0] if len(mags) == 1 else mags[0].unionByName(mags[1])
    parts = []
    if num is not None:
        parts.append(num.select("column", "kind", "statistic", "p_value", "wasserstein_norm", "n_ref"))
    if cat is not None:
        parts.append(cat.select("column", "kind", "statistic", F.lit(None).cast("double").alias("p_value"),
                                F.lit(None).cast("double").alias("wasserstein_norm"), "n_ref"))
    t = parts[0]
    for p in parts[1:]:
        t = t.unionByName(p)
    t = t.join(mag, "column", "left")
    numeric_rule = {"magnitude": F.col("wasserstein_norm") >= magnitude_threshold, "p_value": F.col("p_value") < p_threshold}[method]
    drifted = F.when(F.col("kind") == "numeric", numeric_rule).otherwise(F.col("js_distance") >= magnitude_threshold)
    return t.withColumn("drifted", F.coalesce(drifted, F.lit(False))).drop("n_ref")


def drift_summary(drift: DataFrame, share_threshold: float = S.DRIFT_SHARE_THRESHOLD) -> DataFrame:
    """drift_detected, drift_score (share of drifted columns), counts."""
    return drift.agg(F.count_if("drifted").alias("drifted_columns"),
                     F.count(F.lit(1)).alias("total_columns")).select(
        (F.col("drifted_columns") / F.col("total_columns") >= share_threshold).alias("drift_detected"),
        (F.col("drifted_columns") / F.col("total_columns")).alias("drift_score"),
        "drifted_columns", "total_columns")
