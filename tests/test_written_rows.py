"""Rows that many passes read are written once, not worked out in every pass."""

import re

from conftest import SF_SMALL
from pyspark.sql import functions as F

from demandspark.operators import drift as DR
from demandspark.operators import models as M
from demandspark.plans import q_ml as Q


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_part_of_the_split_is_a_filter_on_written_rows(spark):
    """Hash, cut-off and dates were worked out again for every row, feature and pass."""
    train = Q._split(spark, SF_SMALL).where(F.col("split") == "train")
    assert re.search(r"PushedFilters: \[.*EqualTo\(split,train\)", _plan(train))
    assert not re.search(r"md5|weekday|to_timestamp|gettimestamp", _plan(train))


def test_folds_are_cut_from_written_rows(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(M, "cross_validated", lambda df, *a, **k: seen.append(_plan(df)) or spark.createDataFrame([("m", 0, 1.0)], "model_name string, fold int, rmse double"))
    Q._cross_validated(spark, SF_SMALL, ["Decision Tree"])
    assert not re.search(r"weekday|to_timestamp|gettimestamp", seen[0])


def test_the_monitoring_checks_read_written_rows(spark, monkeypatch):
    """Duplicates, imputation and the feature recipe were worked out in every scan of the checks."""
    seen, real = [], DR.drift_table
    monkeypatch.setattr(DR, "drift_table", lambda ref, cur, *a, **k: seen.extend((_plan(ref), _plan(cur))) or real(ref, cur, *a, **k))
    assert Q.mon_workflow(spark, SF_SMALL).where("type = 'report'").count() == 1
    assert len(seen) == 2 and not any(re.search("HashAggregate|Subquery|weekday", p) for p in seen)


def test_a_batch_is_counted_once(spark, tmp_path, monkeypatch):
    """What the looks at cells scan are counts by value, not the batch's rows; the table is the same."""
    ref = spark.range(1000).select((F.col("id") % 7).cast("double").alias("x"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("s"))
    cur = spark.range(4000).select((F.col("id") % 9).cast("double").alias("x"), F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("s"))
    state = DR.ReferenceState(ref, ["x"], ["s"], str(tmp_path / "state"))
    rows, real = [], DR.NumericDrift
    monkeypatch.setattr(DR, "NumericDrift", lambda r, *a, **k: rows.append(r.count()) or real(r, *a, **k))
    got = state.drift_table(cur).orderBy("column").collect()
    monkeypatch.undo()
    assert rows == [16]
    assert got == DR.drift_table(ref, cur, ["x"], ["s"]).orderBy("column").collect()
