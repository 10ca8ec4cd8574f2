"""Exact, deterministic splits by selection: stratified, hold-out, ordered and k-fold.

Row order inside a stratum is ``md5(key|seed)`` then the key, so the
split is reproducible across engines and reruns (``rand()`` is not).
Rows are not ranked: the row at the wanted rank is selected by counting
hash prefixes (or key ranges), narrowing to one cell, where needed
twice, and ordering only that cell's rows. A split flag is then a comparison with one cut-off
per stratum, so no row of the table is shuffled and nothing is
materialised. Rows without a target form a stratum of their own; rows
without a key come last.
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandspark.functions import scalar as X
from demandspark.operators.profile import finite, with_stats

DIGITS = 3
CELLS = 16 ** DIGITS  # cells of one narrowing step (hex digits)
GATHER = 20_000  # rows of a cell that are ordered by key
NO_TARGET, GONE = -1, -2


def hash_order(key: str, seed: int) -> F.Column:
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))


def _narrow(cells: DataFrame, group: list[str], cell: str) -> DataFrame:
    """The cell of each group that holds rank ``__r``, with the rank inside it.

    ``cells`` has group, cell, __n and the group's __r; at most CELLS rows of a group.
    """
    w = Window.partitionBy(*group).orderBy(cell)
    c = cells.withColumn("__to", F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    hit = c.where((F.col("__to") >= F.col("__r")) & (F.col("__to") - F.col("__n") < F.col("__r")))
    return hit.select(*group, cell, (F.col("__r") - F.col("__to") + F.col("__n")).alias("__r"))


def _rounded(x: float) -> int:
    """Half away from zero, as SQL's round."""
    return int(Decimal(repr(x)).quantize(Decimal(1), ROUND_HALF_UP))


class _Strata:
    """Equal-width bins of a target, and the (hash, key) order of each one's rows.

    Bounds, cut-offs and counts are bounded by the parameters (bins x CELLS
    numbers) and come to the driver; flags are expressions over the row alone.
    """

    def __init__(self, df: DataFrame, key: str, target: str, bins: int, seed: int, without: str | None = None, bounds: tuple | None = None):
        """``without``: a flag column of the rows that have gone already; a filter
        on it would be pushed below the columns that it hangs on and repeat them."""
        self.df, self.key, self.seed, self.bins, self.x = df, key, seed, bins, finite(target)
        if without:
            self.x = F.when(~F.col(without), self.x)
        if bounds is None:
            bound = df.agg(F.min(self.x).alias("mn"), F.max(self.x).alias("mx")).first()
            bounds = bound["mn"], bound["mx"]
        self.bounds = bounds
        own = X.equal_width_bin(self.x, *(F.lit(b).cast("double") for b in self.bounds), bins)
        self.stratum = F.coalesce(own, F.when(F.col(without), F.lit(GONE)) if without else F.lit(NO_TARGET), F.lit(NO_TARGET))
        self.rows = df.select(self.stratum.alias("s"), hash_order(key, seed).alias("h"), F.col(key).alias("k"), self.x.alias("x"))
        self.cells = self._counted(self.rows, F.substring("h", 1, DIGITS).alias("p"))
        self.cells.pop(GONE, None)
        self.sizes = {s: sum(c[1] for c in cells) for s, cells in self.cells.items()}

    @staticmethod
    def _counted(rows: DataFrame, *keys: Column) -> dict[int, list[tuple[str, int, float, float]]]:
        """Each stratum's (cell, rows, least and largest target), in order."""
        found = rows.groupBy("s", *keys).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("mn"), F.max("x").alias("mx")).collect()
        out: dict[int, list] = {}
        for r in sorted(found, key=lambda r: (r["s"], r["p"])):
            out.setdefault(r["s"], []).append((r["p"], r["n"], r["mn"], r["mx"]))
        return out

    def _hit(self, cells: list[tuple], rank: int) -> tuple[str, int, int]:
        """The cell that holds the rank, the rank inside it, and its rows."""
        for p, n, *_ in cells:
            if rank <= n:
                return p, rank, n
            rank -= n
        raise ValueError(rank)

    def cut(self, ranks: dict[tuple[int, int], int]) -> dict[tuple[int, int], dict]:
        """(stratum, number) -> rank becomes h and k of the row there, how many rows beyond the rank share them, and the least and largest targets of its cell's later rows."""
        at = {name: self._hit(self.cells[name[0]], rank) for name, rank in ranks.items()}
        later: dict[tuple[int, int], list[tuple]] = {}  # finer cells of the same cell behind the cut-off
        spark = self.df.sparkSession
        if any(n > GATHER for _, _, n in at.values()):  # a second step: cells of twice as many digits
            wanted = F.broadcast(spark.createDataFrame(sorted({(s, p) for (s, _), (p, _, _) in at.items()}), "s int, p string"))
            inside = self.rows.withColumn("p", F.substring("h", 1, DIGITS)).join(wanted, ["s", "p"])
            fine = self._counted(inside.drop("p"), F.substring("h", 1, 2 * DIGITS).alias("p"))
            at = {name: self._hit([c for c in fine[name[0]] if c[0].startswith(p)], rank) for name, (p, rank, _) in at.items()}
            later = {(s, i): [c for c in fine[s] if c[0].startswith(p[:DIGITS]) and c[0] > p] for (s, i), (p, _, _) in at.items()}
        digits = max((len(p) for p, _, _ in at.values()), default=DIGITS)
        # at most a few rows per stratum and cut-off; a key's rows are one row of counts
        wanted = F.broadcast(spark.createDataFrame([(s, p, i, r) for (s, i), (p, r, _) in at.items()], "s int, p string, i int, r long"))
        cell = F.substring("h", 1, digits).alias("p")
        keys = self.rows.join(F.broadcast(wanted.select("s", "p").distinct()), (F.col("p") == F.substring("h", 1, digits)) & (self.rows["s"] == wanted["s"]), "left_semi")
        keys = keys.groupBy("s", cell, "h", "k").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("mn"), F.max("x").alias("mx"))
        upto = F.sum("n").over(Window.partitionBy("s", "p").orderBy("h", "k").rowsBetween(Window.unboundedPreceding, 0))
        t = keys.withColumn("upto", upto).join(wanted, ["s", "p"])
        here, after = (F.col("upto") >= F.col("r")) & (F.col("upto") - F.col("n") < F.col("r")), F.col("upto") - F.col("n") >= F.col("r")
        got = t.groupBy("s", "p", "i", "r").agg(F.max(F.when(here, F.struct("h", "k", "upto"))).alias("at"), F.min(F.when(after, F.col("mn"))).alias("mn"), F.max(F.when(after, F.col("mx"))).alias("mx")).collect()
        out = {}
        for g in got:
            behind = later.get((g["s"], g["i"]), [])
            out[g["s"], g["i"]] = {"h": g["at"]["h"], "k": g["at"]["k"], "extra": g["at"]["upto"] - g["r"], "cell": g["p"][:DIGITS],
                                   "low": [g["mn"], *(c[2] for c in behind)], "high": [g["mx"], *(c[3] for c in behind)]}
        return out

    def flagged(self, df: DataFrame, out: str, cuts: dict[int, dict]) -> DataFrame:
        """Adds whether a row stands at or before the cut-off of its stratum; not if there is none.

        Hash, stratum and cut-off are columns of their own on the way, so each is computed once.
        """
        kind, numbers = self.df.schema[self.key].dataType, range(NO_TARGET, self.bins)
        s, h, c = (f"__{out}_{x}" for x in "shc")
        cut = F.array(*[F.struct(F.lit(cuts[i]["h"] if i in cuts else None).cast("string").alias("h"), F.lit(cuts[i]["k"] if i in cuts else None).cast(kind).alias("k")) for i in numbers])
        df = df.withColumns({s: F.greatest(self.stratum - NO_TARGET + 1, F.lit(1)).cast("int"), h: hash_order(self.key, self.seed)}).withColumn(c, F.element_at(cut, F.col(s)))
        cut_h, cut_k = F.col(c)["h"], F.col(c)["k"]
        flag = (F.col(h) < cut_h) | ((F.col(h) == cut_h) & F.coalesce(F.col(self.key) <= cut_k, F.lit(True)))
        return df.withColumn(out, F.coalesce(flag, F.lit(False))).drop(s, h, c)

    def later_bounds(self, cuts: dict[int, dict]) -> tuple:
        """Least and largest target of the rows behind the cut-offs."""
        low, high = [], []
        for s, cells in self.cells.items():
            cut = cuts.get(s)
            for p, _, mn, mx in cells:
                if not cut or p > cut["cell"]:
                    low.append(mn)
                    high.append(mx)
            if cut:
                low += cut["low"]
                high += cut["high"]
        return min((v for v in low if v is not None), default=None), max((v for v in high if v is not None), default=None)


def _first_rows(df: DataFrame, key: str, target: str, frac: float, bins: int, seed: int, without: str | None = None, bounds: tuple | None = None) -> tuple[_Strata, dict[int, dict]]:
    """The strata, and the cut-offs of the first round(frac n) rows of each."""
    strata = _Strata(df, key, target, bins, seed, without, bounds)
    ranks = {(s, 0): r for s, n in strata.sizes.items() if (r := _rounded(n * frac))}
    return strata, {s: c for (s, _), c in strata.cut(ranks).items()}


def stratified(df: DataFrame, key: str, target: str, test_size: float = 0.2,
               val_size: float | None = 0.25, bins: int = 5, seed: int = 42,
               out: str = "split") -> DataFrame:
    """``test`` = ``test_size`` of each target stratum; from the rest,
    ``val`` = ``val_size`` of each re-binned stratum; the remainder is
    ``train``. Strata: ``bins`` right-closed equal-width target bins.

    The rest nearly always spans the whole target range, and its strata are the
    first ones then, in the same order: both cut-offs come from one table of
    counts (three scans: bounds, counts, the cut cells' rows). Where the rest's
    bounds differ, or a repeated key straddles a cut-off, the second step counts
    the rest by itself (two scans more; the bounds are known)."""
    test, val = f"__{out}_test", f"__{out}_val"
    if val_size is None:
        strata, cuts = _first_rows(df, key, target, test_size, bins, seed)
        return strata.flagged(df, test, cuts).withColumn(out, F.when(F.col(test), "test").otherwise("train")).drop(test)
    strata = _Strata(df, key, target, bins, seed)
    first = {s: _rounded(n * test_size) for s, n in strata.sizes.items()}
    second = {s: _rounded((n - first[s]) * val_size) for s, n in strata.sizes.items()}
    ranks = {(s, 0): r for s, r in first.items() if r} | {(s, 1): first[s] + r for s, r in second.items() if r}
    cuts = strata.cut(ranks)
    tests = {s: c for (s, i), c in cuts.items() if i == 0}
    told = strata.flagged(df, test, tests)
    bounds = strata.later_bounds(tests)
    if bounds == strata.bounds and not any(c["extra"] for c in tests.values()):
        told = strata.flagged(told, val, {s: c for (s, i), c in cuts.items() if i == 1})
    else:
        inner, more = _first_rows(told, key, target, val_size, bins, seed, test, bounds)
        told = inner.flagged(told, val, more)
    return told.withColumn(out, F.when(F.col(test), "test").when(F.col(val), "val").otherwise("train")).drop(test, val)


def holdout(df: DataFrame, key: str, target: str, test_size: float = 0.2, bins: int = 5,
            seed: int = 42, out: str = "split") -> DataFrame:
    return stratified(df, key, target, test_size, None, bins, seed, out)


def _keys_at(df: DataFrame, key: str, ranks: list[Column]) -> Column:
    """Map from 0, 1, ... to the key at each rank (1-based; expressions over the row count ``n``), by numeric key order."""
    k = F.col(key).cast("double")
    rows = df.select(F.col(key).alias("k")).where(F.col(key).isNotNull())
    d, st = with_stats(rows, {"mn": F.min("k"), "mx": F.max("k"), "n": F.count(F.lit(1))})
    k, lo = F.col("k").cast("double"), st["mn"].cast("double")
    # any rule that never falls as the key rises narrows rightly
    d = d.select("k", st["n"].alias("n"), ((k - lo) / (st["mx"].cast("double") - lo + 1) * CELLS * CELLS).alias("x"))
    d = d.withColumns({"p": F.floor(F.col("x") / CELLS), "q": F.floor("x") % CELLS})
    one = d.groupBy("n", "p").agg(F.count(F.lit(1)).alias("__n"))
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), r.cast("long").alias("r")) for i, r in enumerate(ranks)]))
    one = one.withColumn("w", wanted).select("p", "__n", F.col("w.i").alias("i"), F.col("w.r").alias("__r"))
    first = _narrow(one, ["i"], "p")  # one row per rank
    inside = d.select("k", "p", "q").join(F.broadcast(first), "p")
    two = inside.groupBy("i", "p", "__r", "q").agg(F.count(F.lit(1)).alias("__n"))
    second = _narrow(two, ["i", "p"], "q")
    cell = inside.drop("__r").join(F.broadcast(second), ["i", "p", "q"])
    place = F.row_number().over(Window.partitionBy("i").orderBy("k"))
    hit = cell.withColumn("__i", place).where(F.col("__i") == F.col("__r"))
    return hit.agg(F.map_from_entries(F.collect_list(F.struct("i", "k"))).alias("m")).scalar()


def ordered(df: DataFrame, key: str, test_size: float = 0.2, out: str = "split") -> DataFrame:
    """Head/tail split in (numeric) key order at ``int(n * (1 - test_size))``."""
    # int(n * (1 - test_size)) in exact rational arithmetic
    q = Fraction(1) - Fraction(str(test_size))
    cut = F.floor((F.col("n") * F.lit(q.numerator)) / F.lit(q.denominator))
    head = F.col(key) <= F.try_element_at(_keys_at(df, key, [cut]), F.lit(0))
    return df.withColumn(out, F.when(head, "train").otherwise("test"))


def kfold(df: DataFrame, key: str, k: int = 3, out: str = "fold") -> DataFrame:
    """Contiguous, unshuffled folds in (numeric) key order: fold = (rank-1)*k div n
    (the first n mod k folds get one extra row)."""
    ranks = [F.ceil(F.col("n") * F.lit(f) / F.lit(k)) for f in range(1, k)]
    at = _keys_at(df, key, ranks)
    past = [F.coalesce(F.col(key) > F.try_element_at(at, F.lit(f)), F.lit(False)).cast("int") for f in range(k - 1)]
    return df.withColumn(out, sum(past[1:], past[0]) if past else F.lit(0))
