"""Sources, sinks, scoring with rejects, streaming = batch, runs."""

from pyspark.sql import functions as F

from demandspark import schema as S
from demandspark.operators import runs as RU
from demandspark.operators import scoring as SCO
from demandspark.plans import views as V
from demandspark.session import scratch_path
from demandspark.sources import readers as RD
from demandspark.sources import sinks as SK
from demandspark.streaming import jobs as J

SF = "/root/testdata/sf0.001"


def test_csv_round_trip_latin1(spark):
    raw = {v: k for k, v in S.RENAME_MAP.items()}
    d = V.demand(spark, SF).select(*[f.name for f in S.FACT_SCHEMA.fields])  # original header order
    path = SK.write_csv(d.select(*[F.col(c).alias(f" {raw[c]} ") for c in d.columns]), scratch_path(spark, "t_csv"),
                        encoding="ISO-8859-1")
    back = RD.read_demand_csv(spark, path)  # inferred schema: header names are trimmed then renamed
    assert sorted(back.columns) == sorted(d.columns)
    typed = RD.read_demand_csv(spark, path, schema=S.RAW_CSV_SCHEMA)
    assert typed.select(*d.columns).exceptAll(d).count() == 0


def test_first_available_and_missing_snapshot(spark):
    import pytest

    missing = scratch_path(spark, "nothing")
    assert RD.read_snapshot_csv(spark, missing) is None
    with pytest.raises(FileNotFoundError):
        RD.first_available(spark, [missing])


def test_score_batch_rejects(spark):
    req = spark.createDataFrame(
        [(1, "01/06/2018", 12, 25.0, 50.0, 1.0, 2000.0, 10.0, 1.0, 0.0, 0.0, "Summer", "No Holiday", "Yes"),
         (2, None, None, None, None, None, None, None, None, None, None, None, None, None),
         (3, "2018-06-01", 24, 25.0, 101.0, -1.0, 2000.0, 10.0, 1.0, 0.0, 0.0, "Summer", "No Holiday", "Yes")],
        "obs_id long, date string, hour int, temperature_c double, humidity double, wind_speed double, "
        "visibility_10m double, dew_point_c double, solar_radiation double, rainfall_mm double, snowfall_cm double, "
        "season string, holiday string, functioning_day string")
    out = {r["index"]: r for r in SCO.score_batch(req, SCO.linear_predictor()).collect()}
    assert out[1]["status"] == "success" and out[1]["prediction"] == 15 * 25 + 25 * 12 + 250
    assert out[1]["confidence"] == 0.85
    assert out[2]["status"] == "error" and out[2]["prediction"] is None and "missing hour" in out[2]["error"]
    assert out[3]["status"] == "error" and "hour above 23" in out[3]["error"] and "invalid date" in out[3]["error"]
    t = SCO.score_totals(SCO.score_batch(req, SCO.linear_predictor())).first()
    assert t["total_requests"] == 3 and t["successful_predictions"] == 1


def test_stream_equals_batch_on_closed_windows(spark):
    path = f"{SF}/events*.parquet"
    out, ck = scratch_path(spark, "t_tumble"), scratch_path(spark, "t_tumble_ck")
    J.run_available(J.quality_tumbling(J.events_stream(spark, path)), ck, out)
    streamed = spark.read.parquet(out)
    ev = V.events(spark, SF)
    mx = ev.agg(F.max("ts")).first()[0]
    batch = (ev.groupBy(F.window("ts", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("rows"))
             .where(F.col("w.end") <= F.lit(mx) - F.expr("INTERVAL 1 HOUR"))
             .select(F.col("w.start").alias("window_start"), "rows"))
    assert streamed.select("window_start", "rows").exceptAll(batch).count() == 0
    assert batch.exceptAll(streamed.select("window_start", "rows")).count() == 0


def test_champion_prefers_current_on_tie(spark):
    res = spark.createDataFrame([("A", "r1", 0.8), ("B", "r2", 0.7)], "model_name string, run_id string, test_r2 double")
    versions = spark.createDataFrame([("B (tuned)", 1, "r9", "Production", {})],
                                     "name string, version int, run_id string, stage string, tags map<string,string>")
    runs = spark.createDataFrame([("r9", {"test_r2": 0.8})], "run_id string, metrics map<string,double>")
    assert RU.champion(res, versions, runs).first()["source"] == "current"
    runs = spark.createDataFrame([("r9", {"test_r2": 0.81})], "run_id string, metrics map<string,double>")
    assert RU.champion(res, versions, runs).first()["model_name"] == "B (tuned)"


def test_leaderboard_drops_runs_without_metric(spark):
    runs = spark.createDataFrame(
        [("a", {"model_type": "X"}, {"test_r2": 0.5}), ("b", {}, {"test_rmse": 1.0})],
        "run_id string, params map<string,string>, metrics map<string,double>").withColumn(
        "start_time", F.current_timestamp())
    lb = RU.leaderboard(runs).collect()
    assert [r["run_id"] for r in lb] == ["a"] and lb[0]["test_rmse"] == float("inf")


def test_score_batch_with_fitted_pipeline_keeps_rejects(spark):
    from demandspark.functions.features import feature_recipe
    from demandspark.operators import models as M

    train = feature_recipe(V.demand(spark, SF))
    est = {"Linear Regression": M.estimators()["Linear Regression"]}
    model = M.train_all(train, est, parallelism=1)["Linear Regression"]
    req = V.requests_bad(spark, SF)
    out = SCO.score_batch(req, SCO.model_predictor(model))
    n = req.count()
    assert out.count() == n  # invalid rows are not dropped by the assembler
    bad = out.where(F.col("status") == "error")
    assert bad.where(F.col("prediction").isNotNull()).count() == 0
    assert bad.count() > 0 and out.where(F.col("status") == "success").where(F.col("prediction") < 0).count() == 0


def test_predictions_without_an_actual_leave_with_the_watermark(spark, tmp_path):
    """Three files, one a micro-batch: an actual in time, one too late, none at all, and a prediction without a key."""

    def at(day, minute):
        return f"2024-01-{day:02d} {minute // 60:02d}:{minute % 60:02d}:00"

    preds = [[(1, at(1, 60), 10.0), (2, at(1, 120), 10.0), (3, at(1, 1430), 10.0), (None, at(1, 5), 10.0)],
             [(4, at(2, 60), None), (5, at(2, 90), 4.0)], [(9, at(4, 0), 0.0)]]
    acts = [[(1, at(1, 90), 13.0), (1, at(1, 95), 11.0), (2, at(1, 181), 0.0), (None, at(1, 6), 0.0)],
            [(3, at(2, 20), 14.0), (4, at(2, 61), 1.0)], [(9, at(4, 30), 0.0)]]
    streams = {}
    for name, files, value in (("p", preds, "yhat"), ("a", acts, "y")):
        schema = f"k long, ts timestamp, {value} double"
        for i, rows in enumerate(files):
            df = spark.createDataFrame(rows, f"k long, ts string, {value} double").withColumn("ts", F.col("ts").cast("timestamp"))
            df.coalesce(1).write.mode("append").parquet(str(tmp_path / name / f"part={i}"))
        r = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True)
        streams[name] = r.parquet(str(tmp_path / name))
    out = J.performance_stream(streams["p"], streams["a"].withColumnRenamed("ts", "ats"), "k", "ts", "ats")
    J.run_available(out, str(tmp_path / "ck"), str(tmp_path / "out"))
    got = {str(r["window_start"])[:10]: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert {d: (r["n"], r["unmatched"]) for d, r in got.items()} == {"2024-01-01": (3, 2), "2024-01-02": (1, 1)}
    assert abs(got["2024-01-01"]["mae"] - (3 + 1 + 4) / 3) < 1e-9
    assert got["2024-01-02"]["mae"] is None  # its one matched prediction has no value
