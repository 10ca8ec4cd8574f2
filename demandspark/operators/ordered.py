"""Distributed ordered primitives: running sums and global ranks.

A window ``partitionBy(group).orderBy(value)`` puts every row of a group
into one task; with one column or one stratum holding a third of 100 TB
that task never finishes. Here the ordered scan is split across range
partitions instead:

1. ``repartitionByRange(group, order)`` spreads each group over many
   partitions (sampling-based bounds, like a global sort);
2. the result is checkpointed to the shared checkpoint folder, so
   partition ids stay fixed even if executors are lost and stages rerun;
3. per-(group, partition) totals -- at most #groups + #partitions rows --
   give each partition its offset (a small window);
4. a window over (group, partition) adds the local running sum.

No step holds more than one range partition in a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandspark.session import checkpoint_dir

_PID = "__pid"


def _partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), 1)


def running_totals(df: DataFrame, group: Sequence[str], order: Sequence[str],
                   measures: Sequence[str], prefix: str = "cum_", next_of: str | None = None,
                   num_partitions: int | None = None) -> DataFrame:
    """Add ``cum_<m>``: sum of ``m`` over rows of the same group whose
    ``order`` key is <= this row's (rows must be unique on group + order).

    With ``next_of`` also adds ``next_<next_of>``: the value of that column
    on the following row of the group (NULL on the last row).
    """
    group, order, measures = list(group), list(order), list(measures)
    n = _partitions(df, num_partitions)
    r = df.repartitionByRange(n, *[F.col(c) for c in group + order]).withColumn(_PID, F.spark_partition_id())
    checkpoint_dir(df.sparkSession)
    r = r.checkpoint(eager=True)
    aggs = [F.sum(m).alias(f"__tot_{m}") for m in measures]
    if next_of:
        aggs.append(F.min_by(F.col(next_of), F.struct(*[F.col(c) for c in order])).alias("__first"))
    tot = r.groupBy(*group, _PID).agg(*aggs)
    w_prev = Window.partitionBy(*group).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    off_cols = [F.coalesce(F.sum(f"__tot_{m}").over(w_prev), F.lit(0)).alias(f"__off_{m}") for m in measures]
    if next_of:
        off_cols.append(F.lead("__first").over(Window.partitionBy(*group).orderBy(_PID)).alias("__next_first"))
    offsets = tot.select(*group, _PID, *off_cols)
    j = r.join(offsets, on=group + [_PID], how="left")
    w = Window.partitionBy(*group, _PID).orderBy(*order)
    w_run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = {f"{prefix}{m}": F.sum(m).over(w_run) + F.col(f"__off_{m}") for m in measures}
    if next_of:
        out[f"next_{next_of}"] = F.coalesce(F.lead(next_of).over(w), F.col("__next_first"))
    res = j.withColumns(out)
    drop = [_PID] + [f"__off_{m}" for m in measures] + (["__next_first"] if next_of else [])
    return res.drop(*drop)


def global_rank(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """1-based ``row_number`` within ``group`` ordered by ``order`` (unique),
    computed without a single-task window."""
    one = "__one"
    r = running_totals(df.withColumn(one, F.lit(1)), group, order, [one], prefix="__cum",
                       num_partitions=num_partitions)
    return r.withColumnRenamed(f"__cum{one}", out).drop(one)
