"""Quality rules: base limits, then robust multivariate outliers.

Every text's statistics come from one pass of built-in expressions. Documents
that pass the base limits are then judged together: per language and source the
minimum-covariance-determinant estimate of the transformed statistics is
sought by concentration steps from three starts (medians with the least
deviations, medians with equal deviations, mean and covariance of all), all
starts of all groups in the same steps, until no start's determinant falls any
more. The start with the smallest determinant gives the group's estimate, and
documents whose Mahalanobis distance from it is above the cut-off are rejected.

A concentration step bins the squared distances and sums, per group and bin,
the counts and first and second moments; the bins up to the one that holds the
h-th smallest distance give the next mean and covariance. So a step is one
aggregation with partial sums, and a group of any size leaves a bounded number
of rows. The statistics are fixed-point integers, so sums don't depend on their
order and reruns agree. Each statistic has a least deviation, whose square is
added to its variance: it keeps covariance and determinant regular where a
group's documents hardly differ.

DataFrame functions only.

Defined cases: a null text has no words and fails the base limits; null
languages and sources are groups of their own; null ids and repeated rows are
kept, each row judged for itself; an empty table gives an empty result. Only
id, text, language and source are read, so other names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandspark.llm.common import stash

GAP = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]"
SYMBOL = "[#*$%&|<>]"
WINDOW = 5
UNIT = 1024  # fixed-point unit of the transformed statistics
LEAST = (0.12, 0.05, 0.10, 0.12)  # least deviations
COVER = 0.75  # share of a group's documents in the estimate
SPREAD = 1.486  # consistency factor for COVER and four dimensions
CUTOFF = 23.5  # chi-square, four degrees of freedom, 0.9999
EQUAL = 0.1  # deviations of the second start
FALLS = 1e-4  # a log determinant that falls by less has converged
STEPS = 30  # binned subsets could alternate without end; steps converge long before
BROADCAST_GROUPS = 50_000  # estimates of so many groups stay under 20 MB
GROUP = ["_lang", "_source"]
DIMS = range(len(LEAST))


def repeated_words(placed: str) -> Column:
    """Words in windows whose hash occurs twice or more; column ``placed`` has (hash h, place i), sorted."""
    def again(p: Column, i: Column) -> Column:
        return F.when(((i > 0) & (F.get(placed, i - 1)["h"] == p["h"])) | (F.get(placed, i + 1)["h"] == p["h"]), p["i"])

    twice = F.filter(F.transform(placed, again), lambda i: i.isNotNull())
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(F.sort_array(twice), start, lambda a, i: F.struct((i + WINDOW).alias("end"), (a["n"] + F.least(F.lit(WINDOW), i + WINDOW - a["end"])).alias("n")), lambda a: a["n"])


def text_statistics(df: DataFrame, text: str) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of the column ``text``."""
    df = df.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    df = df.withColumn("_words", F.array_remove(F.split("_text", GAP), ""))
    df = df.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda line: F.rlike(line, F.lit(WORD))))
    n = F.size("_words")
    windows = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*(F.get("_words", i + k) for k in range(WINDOW))))
    df = df.withColumn("_windows", F.when(n >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")))
    # only texts that repeat a window sort their windows' places
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    df = df.withColumn("_placed", F.when(repeats, F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    repeated = F.when(F.col("_placed").isNotNull(), repeated_words("_placed")).otherwise(0)
    return df.select(
        "*", n.cast("long").alias("n_words"), F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"), repeated.cast("long").alias("n_repeat_words"),
    ).drop("_text", "_words", "_lines", "_windows", "_placed")


def transformed(df: DataFrame) -> DataFrame:
    """Adds the fixed-point statistics _x0.._x3 (null for texts without words)."""
    word = F.col("n_words")
    values = (F.log(F.col("word_chars") / word), F.sqrt(F.col("n_symbols") / F.col("word_chars")), F.sqrt(F.col("n_dup_lines") / word), F.sqrt(F.col("n_repeat_words") / word))
    return df.withColumns({f"_x{k}": F.when(word > 0, F.round(v * UNIT).cast("long")) for k, v in enumerate(values)})


def with_estimates(df: DataFrame, estimates: DataFrame, few: bool) -> DataFrame:
    found = estimates.select(F.col("_lang").alias("_l"), F.col("_source").alias("_s"), *(c for c in estimates.columns if c not in GROUP))
    found = F.broadcast(found) if few else found
    return df.join(found, F.col("_lang").eqNullSafe(F.col("_l")) & F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_l", "_s")


def distance(df: DataFrame) -> DataFrame:
    """Adds _d, the squared Mahalanobis distance, by forward substitution with the estimate's Cholesky factor."""
    solved: list[Column] = []
    for k in DIMS:
        rest = F.col(f"_x{k}") - F.col(f"_m{k}")
        for j in range(k):
            rest = rest - F.col(f"_c{k}{j}") * F.col(f"_y{j}")
        df = df.withColumn(f"_y{k}", rest / F.col(f"_c{k}{k}"))
        solved.append(F.col(f"_y{k}") * F.col(f"_y{k}"))
    return df.withColumn("_d", sum(solved[1:], solved[0])).drop(*(f"_y{k}" for k in DIMS))


def factored(df: DataFrame) -> DataFrame:
    """Cholesky factor _c of the covariance _v (lower triangles)."""
    for j in DIMS:
        own = F.col(f"_v{j}{j}")
        for m in range(j):
            own = own - F.col(f"_c{j}{m}") * F.col(f"_c{j}{m}")
        df = df.withColumn(f"_c{j}{j}", F.sqrt(own))
        for k in range(j + 1, len(LEAST)):
            rest = F.col(f"_v{k}{j}")
            for m in range(j):
                rest = rest - F.col(f"_c{k}{m}") * F.col(f"_c{j}{m}")
            df = df.withColumn(f"_c{k}{j}", rest / F.col(f"_c{j}{j}"))
    return df


def kept_part() -> list[str]:
    return [*GROUP, "_start", "_det", *(f"_m{k}" for k in DIMS), *(f"_c{k}{j}" for k in DIMS for j in range(k + 1))]


def moments() -> list[Column]:
    return [F.count("*").alias("_n"), *(F.sum(f"_x{k}").alias(f"_s{k}") for k in DIMS), *(F.sum(F.col(f"_x{k}") * F.col(f"_x{j}")).alias(f"_p{k}{j}") for k in DIMS for j in range(k + 1))]


def estimated(sums: DataFrame) -> DataFrame:
    """Mean, covariance's factor and log determinant from summed moments."""
    sums = sums.withColumns({f"_m{k}": F.col(f"_s{k}") / F.col("_n") for k in DIMS})

    def spread(k: int, j: int) -> Column:
        v = SPREAD * (F.col(f"_p{k}{j}") / F.col("_n") - F.col(f"_m{k}") * F.col(f"_m{j}"))
        return v + (LEAST[k] * UNIT) ** 2 if j == k else v

    found = factored(sums.withColumns({f"_v{k}{j}": spread(k, j) for k in DIMS for j in range(k + 1)}))
    return found.withColumn("_det", 2 * sum((F.log(f"_c{k}{k}") for k in DIMS[1:]), F.log("_c00")))


def first_estimates(rows: DataFrame) -> DataFrame:
    """Three starts per group; medians are to the sixteenth of a unit's 64th."""
    step = UNIT // 64
    one = rows.select(*GROUP, F.posexplode(F.array(*(F.floor(F.col(f"_x{k}") / step) for k in DIMS))).alias("_k", "_bin"))
    bins = one.groupBy(*GROUP, "_k", "_bin").agg(F.count("*").alias("_n"))
    over = Window.partitionBy(*GROUP, "_k")
    bins = bins.withColumn("_upto", F.sum("_n").over(over.orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0))).withColumn("_all", F.sum("_n").over(over))
    medians = bins.where(2 * F.col("_upto") >= F.col("_all")).groupBy(*GROUP).agg(*(F.min(F.when(F.col("_k") == k, F.col("_bin"))).alias(f"_b{k}") for k in DIMS))
    medians = medians.withColumns({f"_m{k}": (F.col(f"_b{k}") + 0.5) * step for k in DIMS})

    def around(start: int, deviations: tuple[float, ...]) -> DataFrame:
        told = medians.withColumns({f"_v{k}{j}": F.lit((deviations[k] * UNIT) ** 2 if j == k else 0.0) for k in DIMS for j in range(k + 1)})
        return factored(told).withColumns({"_start": F.lit(start), "_det": F.lit(float("inf"))}).select(*kept_part())

    every = estimated(rows.groupBy(*GROUP).agg(*moments())).withColumns({"_start": F.lit(2), "_det": F.lit(float("inf"))}).select(*kept_part())
    return around(0, LEAST).unionByName(around(1, (EQUAL,) * len(LEAST))).unionByName(every)


def concentrated(rows: DataFrame, estimates: DataFrame, few: bool) -> DataFrame:
    """One concentration step: estimates from the COVER nearest documents of each group and start, with the determinant before."""
    near = distance(with_estimates(rows, estimates, few)).withColumn("_bin", F.floor(32 * F.log1p("_d")))
    keys = [*GROUP, "_start"]
    bins = near.groupBy(*keys, "_bin").agg(*moments(), F.max("_det").alias("_was"))
    over = Window.partitionBy(*keys)
    bins = bins.withColumn("_before", F.coalesce(F.sum("_n").over(over.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("_all", F.sum("_n").over(over))
    taken = bins.where(F.col("_before") < F.ceil(COVER * F.col("_all")))
    total = taken.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in bins.columns if c[:2] in ("_n", "_s", "_p") and c not in keys), F.max("_was").alias("_was"))
    return estimated(total).select(*kept_part(), "_was")


def least_determinant(rows: DataFrame, estimates: DataFrame, few: bool) -> DataFrame:
    """Each group's estimate: steps from all starts until none falls, then the start of the smallest determinant."""
    for step in range(STEPS):
        estimates = stash(concentrated(rows, estimates, few), f"quality-step{step}")
        if not estimates.where(F.col("_was") - F.col("_det") > FALLS).head(1):
            break
    rest = [c for c in kept_part() if c not in GROUP]
    best = estimates.groupBy(*GROUP).agg(F.min(F.struct("_det", "_start", *(c for c in rest if c not in ("_det", "_start")))).alias("_best"))
    return stash(best.select(*GROUP, *(F.col(f"_best.{c}").alias(c) for c in rest)), "quality-estimates")


def judged(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, the statistics, base_failed, distance and kept of every row; columns named in ``carry`` come along as carried_<name>."""
    rows = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_raw"), F.col(lang_col).alias("_lang"), F.col(source_col).alias("_source"), *(F.col(c).alias(f"_carry_{c}") for c in carry))
    rows = transformed(text_statistics(rows, "_raw").drop("_raw"))
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = stash(rows.withColumn("base_failed", base), "quality-statistics")
    sound = rows.where(~F.col("base_failed")).select(*GROUP, *(f"_x{k}" for k in DIMS))
    estimates = stash(first_estimates(sound), "quality-start")
    few = estimates.count() <= BROADCAST_GROUPS
    estimates = least_determinant(sound, estimates, few)
    far = distance(with_estimates(rows, estimates, few))
    return far.select(
        F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("_d") <= CUTOFF)).alias("kept"), F.col("_d").alias("distance"), *(F.col(f"_carry_{c}").alias(f"carried_{c}") for c in carry),
    )
