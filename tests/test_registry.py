"""Driver contract: entry, query registry and oracle agreement (sf0.001)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402

FAST_ORACLE_KEYS = [
    "agg_mean_hour_season", "fn_feature_recipe", "agg_describe", "agg_histogram", "agg_correlation",
    "cln_mean_impute", "split_stratified", "eval_model_table", "run_leaderboard", "join_artifact_reconcile",
    "mon_drift_numeric", "score_batch", "st_quality_tumbling", "tune_trials_table",
]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["hour", "season", "avg_count", "n"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", FAST_ORACLE_KEYS)
def test_oracle_agreement(spark, key):
    from tools.oracle_check import compare, duck

    sf = "/root/testdata/sf0.001"
    r = compare(E.queries()[key](spark, sf), E.oracle_sql()[key], duck(sf))
    assert r["exact"] and not r["type_mismatch"], r
