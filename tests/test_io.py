"""Sources and sinks: files in, files out, and back again."""

import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from demandcast.operators import clean, selection, supply
from demandcast.operators.metrics import metrics_by_h, metrics_overall
from demandcast.sources import external, readers, writers
from demandcast.streaming.rollup import stream_transactions

D = dt.date


@pytest.fixture
def forecasts(spark):
    rows = [(D(2024, 1, h), p, h, float(h), h + k, h + k - 1.0, h + k + 1.0, m)
            for h in (1, 2) for p in ("a", "b") for m, k in (("x", 0.5), ("naive1", 2.0))]
    return spark.createDataFrame(rows, readers.FORECAST_SCHEMA)


def test_feature_csv_needs_a_date(spark, tmp_path):
    (tmp_path / "ok.csv").write_text("date,product_a,product_b,y\n2024-01-02,1,0,3\nbad,0,1,4\n")
    df = clean.reverse_one_hot(readers.read_features(spark, str(tmp_path / "ok.csv"), "date string, product_a int, product_b int, y int"))
    assert [(r.date, r.product) for r in df.collect()] == [(D(2024, 1, 2), "a"), (None, "b")]
    (tmp_path / "no.csv").write_text("day,y\n2024-01-02,3\n")
    with pytest.raises(ValueError):
        readers.read_features(spark, str(tmp_path / "no.csv"))
    with pytest.raises(ValueError):
        clean.reverse_one_hot(spark.createDataFrame([(1,)], "y int"))


def test_cached_copy_wins(spark, tmp_path):
    csv, pq = str(tmp_path / "raw.csv"), str(tmp_path / "raw.parquet")
    (tmp_path / "raw.csv").write_text("a\n1\n2\n")
    assert readers.read_cached(spark, pq, csv).count() == 2
    spark.range(5).write.parquet(pq)
    assert readers.read_cached(spark, pq, csv).count() == 5
    with pytest.raises(FileNotFoundError):
        readers.read_cached(spark, pq + "x", csv + "x")


def test_lenient_scan_reads_whole_numbers_as_double(spark, tmp_path):
    (tmp_path / "l.csv").write_text("n,t\n1,x\n,y\n")
    df = readers.read_lenient(spark, str(tmp_path / "l.csv"))
    assert dict(df.dtypes)["n"] == "double" and df.where("n IS NULL").count() == 1


def test_metric_files_carry_their_model(spark, tmp_path):
    (tmp_path / "m1_metrics_overall.csv").write_text("MAE,RMSE,MAPE,sMAPE\n1,2,3,4\n")
    (tmp_path / "m2_metrics_overall.csv").write_text("MAE,RMSE,MAPE,sMAPE,COV_p10_p90_%\n1,2,3,2,80\n")
    (tmp_path / "all_models_metrics_overall.csv").write_text("MAE,RMSE,MAPE,sMAPE,model\n1,2,3,0,z\n")
    (tmp_path / "m1_metrics_by_h.csv").write_text("h,MAE,RMSE,MAPE,sMAPE\n1,1,2,3,4\n2,1,2,3,5\n")
    df = readers.read_overall_metrics(spark, str(tmp_path))
    assert sorted(r.model for r in df.collect()) == ["m1", "m2"]
    assert selection.model_ranking(df).first().model == "m2"
    assert readers.read_metrics_by_h(spark, str(tmp_path)).count() == 2


def test_forecast_files_line_up(spark, tmp_path):
    (tmp_path / "b_forecasts.csv").write_text("date,product,h,y,yhat,model\n2024-01-01,a,1,3.0,,naive1\n")
    (tmp_path / "c_forecasts.csv").write_text("date,product,h,y,yhat,yhat_p10,yhat_p90,model\n2024-01-01,a,1,3.0,2.0,1.0,4.0,c\n")
    df = readers.read_forecasts(spark, str(tmp_path), ["b", "c", "gone"])
    got = {r.family: r for r in df.collect()}
    assert got["b"].yhat_p10 is None and got["b"].yhat is None and got["c"].yhat_p90 == 4.0
    with pytest.raises(FileNotFoundError):
        readers.read_forecasts(spark, str(tmp_path), ["gone"])


def test_snapshot_and_schema(spark, tmp_path):
    df = spark.range(3000).withColumn("x", F.col("id") * 1.5)
    art = writers.write_snapshot(df, str(tmp_path))
    assert spark.read.parquet(f"{art}/df_final.parquet").count() == 3000
    assert spark.read.csv(f"{art}/df_final_sample.csv", header=True).count() == 1000
    assert spark.read.csv(f"{art}/df_final_schema.csv", header=True).count() == 2


def test_forecast_sink_replaces_only_its_models(spark, tmp_path, forecasts):
    paths = writers.write_forecasts(forecasts, str(tmp_path))
    writers.write_forecasts(forecasts.where("model = 'x'").limit(1), str(tmp_path))
    back = spark.read.parquet(paths["forecasts"])
    assert {r.model: r.n for r in back.groupBy("model").agg(F.count("*").alias("n")).collect()} == {"x": 1, "naive1": 4}
    assert spark.read.parquet(paths["metrics_overall"]).where("model = 'naive1'").first().MAE == 2.0


def test_run_log_keys_and_rounding(spark, tmp_path, forecasts):
    log = writers.run_log(metrics_overall(forecasts), metrics_by_h(forecasts))
    keys = {r.key for r in log.collect()}
    assert "COV_p10_p90_pct" in keys and "COV_p10_p90_pct_by_h" in keys and "MAE_by_h" in keys
    assert log.where("key = 'MAE' AND run = 'x'").first().value == 0.5
    writers.append_log(log, str(tmp_path / "log"))
    writers.append_log(log, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2 * log.count()
    params = writers.parameter_log(spark, "r", {"a b": 1, "c": [1, 2], "d": None}, {"stage": "eval"})
    assert {(r.kind, r.key, r.value) for r in params.collect()} == {
        ("param", "a_b", "1"), ("param", "c", "[1, 2]"), ("param", "d", None), ("tag", "stage", "eval")}


def test_version_manifest_registry(spark, tmp_path, forecasts):
    params = {"b": 2, "a": [1]}
    v = spark.range(1).select(writers.version_id(params, "20240101-000000", "t").alias("v")).first().v
    assert v == "v20240101-000000-" + hashlib.sha1(json.dumps(params, sort_keys=True).encode()).hexdigest()[:8] + "-t"
    for i in range(12):
        writers.write_manifest(spark, str(tmp_path), "seasonal ar", f"v{i:02d}", {"i": i})
    shown = writers.list_versions(spark, str(tmp_path)).collect()
    assert len(shown) == 10 and shown[0].version == "v11" and shown[0].model == "seasonal_ar"
    best = selection.select_simple(metrics_overall(forecasts))
    writers.write_registry(best, str(tmp_path), 7, trained_at="20240101_000000")
    entry = spark.read.json(str(tmp_path / "registry")).first().best_model
    assert entry.name == best.first().model and entry.horizon == 7 and entry.metric == "sMAPE"


def test_fingerprints_dictionary_features(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a\n1\n")
    prints = readers.file_fingerprints(spark, str(tmp_path / "in.csv"))
    assert prints.first().sha1 == hashlib.sha1(b"a\n1\n").hexdigest()
    assert json.loads(writers.run_metadata(spark, {"h": 7}, prints).first().params) == {"h": 7}
    out = writers.write_enriched(spark.range(2), str(tmp_path), {"id": "row number"})
    assert spark.read.csv(out["dictionary"], header=True).first().description == "row number"
    writers.write_feature_list(spark, ["b", "a"], str(tmp_path))
    assert spark.read.csv(str(tmp_path / "features_selected"), header=True).count() == 2


def test_weather_files_and_holiday_regions(spark, tmp_path):
    doc = {"hourly": {"time": ["2024-07-01T00:00", "2024-07-01T01:00", "bad"], "temperature_2m": [20.5, None, 1.0], "rain": [1, 2, 3]}}
    (tmp_path / "w.json").write_text(json.dumps(doc))
    wx = external.read_weather(spark, str(tmp_path / "w.json"), ("temperature_2m", "precipitation"))
    assert [(r.temperature_2m, r.precipitation) for r in wx.orderBy("hour_utc").collect()] == [(20.5, None), (None, None)]
    days = [{"date": "2024-08-24", "localName": "Independence", "counties": None},
            {"date": "2024-08-25", "localName": "Region", "counties": ["UA-05"]},
            {"date": "2024-08-26", "localName": "Other", "counties": ["UA-63"]}, {"date": "x", "localName": "bad"}]
    df = spark.createDataFrame([(json.dumps(days),)], "payload string")
    assert [r.holiday_name for r in external.public_holidays(df, regions=["UA-05"]).orderBy("date").collect()] == ["Independence", "Region"]
    assert external.public_holidays(df).count() == 3
    sales = spark.createDataFrame([("2024-07-01 01:40:00",), ("2024-08-23 22:00:00",)], "t string").select(F.col("t").cast("timestamp").alias("datetime"))
    rich = external.enrich_sales(sales, wx, external.public_holidays(df), zone="Europe/Kyiv").orderBy("datetime").collect()
    assert rich[0].wx_temperature_2m is None and not rich[0].is_holiday
    assert rich[1].is_holiday and rich[1].holiday_name == "Independence"  # 22:00 UTC is the 24th in Kyiv


def test_schema_report_and_names(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    rep = {r["column"]: r for r in clean.schema_report(df, {"a": "numeric", "c": "string-like"}).collect()}
    assert rep["a"]["exists"] and rep["c"].inferred_dtype == "MISSING" and clean.missing_columns(df, ["a", "c"]) == ["c"]
    assert clean.pick_numeric(df, "a") == "a"
    with pytest.raises(KeyError):
        clean.pick_numeric(df, "b")
    assert clean.resolve_datetime(spark.createDataFrame([("2024-01-01",)], "Fecha string")).first().datetime.year == 2024
    assert clean.sequence_features(spark.createDataFrame([("a", 1.0, 2.0)], "product string, z double, y_1 double")) == ["z"]
    with pytest.raises(ValueError):
        clean.check_forecast(df)
    assert clean.random_sample(spark.range(50), 10).count() == 10


def test_default_recipes_drop_unknown_products(spark):
    fc = spark.createDataFrame([(" latte ", 100.0), ("tea", 50.0), ("mocha", 10.0)], "product string, forecast double")
    prices = spark.createDataFrame([("Latte", 40.0), ("Mocha", 0.0), ("Tea", 5.0)], "product string, unit_price double")
    detail = supply.supply_detail(fc, prices, supply.recipe_table(spark), supply.cost_table(spark))
    assert {r.ingredient: r.quantity for r in detail.collect()} == {"coffee_g": 45.0, "milk_ml": 500.0, "sugar_g": 25.0}
    fin = supply.finance_summary(detail).first()
    assert fin.revenue == 100 and fin.total_cost == pytest.approx(45 + 20 + 1.25) and fin.profit == pytest.approx(33.75)


def test_stream_equals_batch(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").select(
        F.col("ts").cast("timestamp").alias("datetime"), F.col("event_type").alias("product"), F.col("value").alias("amount"))
    events.orderBy("datetime").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = stream_transactions(stream, "day", category="product").writeStream.format("parquet").option(
        "path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    from demandcast.operators.rollup import aggregate_transactions

    batch = aggregate_transactions(events, "day", category="product", full_grid=False)
    # The last window stays open until the watermark passes it.
    closed = batch.where(F.col("datetime") < got.agg(F.max("datetime")).first()[0] + F.expr("INTERVAL 1 DAY"))
    both = got.alias("g").join(closed.alias("b"), ["datetime", "product"], "full")
    assert got.count() > 100 and both.where("g.transactions IS DISTINCT FROM b.transactions OR abs(g.amount - b.amount) > 1e-6").count() == 0
