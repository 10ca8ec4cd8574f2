"""Exact order statistics by narrowing, without sorting or shuffling values.

A double has an order-preserving 64-bit image: its sign, exponent and
mantissa as one integer. The row at a rank is found by counting the
values under each image prefix, going on with the one cell that holds
the rank and a longer prefix, until the cell holds one value, or few
enough to gather. Each step is one scan for all columns and ranks at
once; what it shuffles are counts (columns x prefixes met), and what
comes to the driver is one row per column and rank.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = (20, 32, 44, 56, 64)  # prefix lengths: sign, exponent and 8 bits of the mantissa first
GATHER = 50_000  # values of a cell that are gathered and ordered
_MANTISSA = 1 << 52
_LOWEST, _HIGHEST = -1022, 1023  # exponents of normal doubles


def with_image(df: DataFrame, x: str, out: str) -> DataFrame:
    """Adds the order-preserving long of a finite double column without NULL (-0.0 is 0.0).

    The logarithm only proposes the exponent; the quotient by that power of
    two decides it, so the result is the double's bit pattern exactly. One
    projection per step: what a step uses twice is computed once.
    """
    g, q, bits = f"__{out}_g", f"__{out}_q", f"__{out}_b"
    df = df.withColumn(g, F.least(F.greatest(F.floor(F.log2(F.abs(x))), F.lit(_LOWEST)), F.lit(_HIGHEST)).cast("int"))
    df = df.withColumn(q, F.abs(x) / F.pow(F.lit(2.0), F.col(g).cast("double")))
    # the proposal is one too high or too low next to some powers of two
    high, low = F.col(q) >= 2, (F.col(q) < 1) & (F.col(g) > _LOWEST)
    e = F.when(high, F.col(g) + 1).when(low, F.col(g) - 1).otherwise(F.col(g))
    m = F.when(high, F.col(q) / 2).when(low, F.col(q) * 2).otherwise(F.col(q))
    df = df.withColumn(bits, (e - _LOWEST).cast("long") * F.lit(_MANTISSA) + (m * F.lit(float(_MANTISSA))).cast("long"))
    v = F.when(F.col(x) == 0, F.lit(0).cast("long")).when(F.col(x) < 0, -F.col(bits)).otherwise(F.col(bits))
    # never NULL, and known to be: else joins on it push a NULL test of the whole expression down to the scan
    return df.withColumn(out, F.coalesce(v, F.lit(0).cast("long"))).drop(g, q, bits)


def value_of(bits: int) -> float:
    """The double with this image."""
    value = struct.unpack("<d", struct.pack("<q", abs(bits)))[0]
    return -value if bits < 0 else value


def prefix(v: Column | str, bits: int) -> Column:
    return F.shiftright(v, 64 - bits)


def long_images(df: DataFrame, values: Sequence[Column]) -> DataFrame:
    """(c, v): position in ``values`` and image of every non-NULL value."""
    rows = df.select(F.posexplode(F.array(*[x.cast("double") for x in values])).alias("c", "x"))
    return with_image(rows.where(F.col("x").isNotNull()), "x", "v").select("c", "v")


def select_ranks(df: DataFrame, values: Sequence[Column], ranks: Sequence[Sequence[int]], gather: int = GATHER) -> list[dict[int, float]]:
    """For each of ``values`` (finite doubles or NULL) the value at each of its 0-based ``ranks``."""
    spark, rows = df.sparkSession, long_images(df, values)
    found: list[dict[int, float]] = [{} for _ in values]
    open_ = [(c, None, r, r) for c, own in enumerate(ranks) for r in sorted(set(own))]  # column, cell, rank, rank inside the cell
    for level, bits in enumerate(BITS):
        if not open_:
            break
        # one row per column and rank
        wanted = F.broadcast(spark.createDataFrame(open_, "c int, p long, rank long, r long"))
        if level:
            cells = F.broadcast(spark.createDataFrame(sorted({(c, p) for c, p, _, _ in open_}), "c int, p long"))
            inside = rows.withColumn("p", prefix("v", BITS[level - 1])).join(cells, ["c", "p"])
        else:
            inside = rows.withColumn("p", F.lit(None).cast("long"))
        counts = inside.groupBy("c", "p", prefix("v", bits).alias("q")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        upto = F.sum("n").over(Window.partitionBy("c", "p").orderBy("q").rowsBetween(Window.unboundedPreceding, 0))
        counts = counts.withColumn("upto", upto).withColumnRenamed("c", "c2").withColumnRenamed("p", "p2")
        here = (F.col("c") == F.col("c2")) & F.col("p").eqNullSafe(F.col("p2")) & (F.col("upto") > F.col("r")) & (F.col("upto") - F.col("n") <= F.col("r"))
        hits = counts.join(wanted, here).select("c", "q", "rank", (F.col("r") - F.col("upto") + F.col("n")).alias("r"), "n", "lo", "hi").collect()
        found_now = [h for h in hits if h["lo"] == h["hi"]]
        for h in found_now:
            found[h["c"]][h["rank"]] = value_of(h["lo"])
        left = [h for h in hits if h["lo"] != h["hi"]]
        open_ = [(h["c"], h["q"], h["rank"], h["r"]) for h in left]
        if open_ and all(h["n"] <= gather for h in left):
            wanted = F.broadcast(spark.createDataFrame(open_, "c int, p long, rank long, r long"))
            cells = F.broadcast(spark.createDataFrame(sorted({(c, p) for c, p, _, _ in open_}), "c int, p long"))
            few = rows.withColumn("p", prefix("v", bits)).join(cells, ["c", "p"]).groupBy("c", "p").agg(F.sort_array(F.collect_list("v")).alias("all"))
            for h in few.join(wanted, ["c", "p"]).select("c", "rank", F.element_at("all", (F.col("r") + 1).cast("int")).alias("v")).collect():
                found[h["c"]][h["rank"]] = value_of(h["v"])
            open_ = []
    return found


def interpolated(n: int, prob: float, at: dict[int, float]) -> float | None:
    """The quantile between the values at the two ranks next to (n - 1) x prob."""
    if not n:
        return None
    lo, hi, h = *quantile_ranks(n, prob), (n - 1) * prob
    return at[lo] + (h - lo) * (at[hi] - at[lo])


def quantile_ranks(n: int, prob: float) -> tuple[int, int]:
    lo = int((n - 1) * prob)
    return lo, min(lo + ((n - 1) * prob > lo), n - 1)
