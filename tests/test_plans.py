"""Plan shape: what is scanned, how often data moves, and what happens to hot keys."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from catalog.base import panel, sales, table
from demandcast.functions.ordered import ordered_slices, running_total, slice_count
from demandcast.models import series
from demandcast.operators import baselines, features, kpi, splits
from demandcast.operators.grid import complete_calendar
from demandcast.operators.quality import Rule, bad_samples
from demandcast.operators.rollup import aggregate_transactions
from demandcast.session import materialise, scratch_dir


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return plan(df).count("Exchange hashpartitioning")


def test_scan_reads_two_columns_and_pushes_filters(spark, sf):
    text = plan(aggregate_transactions(sales(spark, sf), "hour"))
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in text
    assert text.count("FileScan parquet") == 1
    sliced = sales(spark, sf).where(F.col("product") == "click").groupBy("product").agg(F.sum("amount"))
    assert "EqualTo(event_type,click)" in plan(sliced)


def test_calendar_costs_one_more_exchange_than_the_sums(spark, sf):
    base = panel(spark, sf)
    assert exchanges(complete_calendar(base)) == exchanges(base) + 1
    assert plan(complete_calendar(base)).count("FileScan") == plan(base).count("FileScan")


def test_all_causal_features_share_one_exchange(spark, sf):
    stored = materialise(panel(spark, sf))
    df = features.add_labels(features.add_causal_features(complete_calendar(stored)))
    assert exchanges(df) == 1


def test_backtests_move_the_panel_once(spark, sf):
    stored = materialise(complete_calendar(panel(spark, sf), fill={"y": 0.0}))
    origins = materialise(splits.rolling_origins(stored))
    for fn in (baselines.baseline_forecasts, series.additive_forecasts, series.seasonal_ar_forecasts):
        assert exchanges(fn(stored, origins)) == 1, fn


QUICK = ["tx_daily_by_product", "panel_complete", "baseline_forecasts", "metrics_by_h", "kpi_row", "supply_detail",
         "forecast_change", "validation_view", "product_share_smoothed", "tx_weather_join", "exog_daily", "amount_hist"]


@pytest.mark.parametrize("name", QUICK)
def test_no_cross_joins(spark, sf, name):
    text = plan(entry.queries()[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_slices_split_a_hot_value(spark):
    """Rows of one leading value spread over slices when a second column orders them."""
    df = spark.range(40_000).select(F.lit(1).alias("hot"), F.col("id"))
    sizes = ordered_slices(df.repartition(8), [F.col("hot"), F.col("id")], {"id": "upto"}, slices=4).groupBy("_slice").count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 20_000


def test_running_totals_move_rows_once(spark):
    """The order's range exchange is the only one that rows pass; ties, NULLs and negative values sum as in one list."""
    rows = [(i % 7 // 2, i, None if i % 11 == 0 else float(i % 5 - 2)) for i in range(2_000)]
    df = materialise(spark.createDataFrame(rows, "tie int, id int, v double"))
    sliced = df.repartitionByRange(4, "tie", "id").sortWithinPartitions("tie", "id")
    assert plan(sliced).count("Exchange") == 1
    got = running_total(df, [F.col("tie"), F.col("id")], {"v": "cum", "id": "ids"}, "rank", slices=4, totals=True)
    assert "hashpartitioning(_slice" not in plan(got.select("cum")).split("BroadcastExchange")[0]
    cum = ids = 0
    for place, (have, (tie, i, v)) in enumerate(zip(got.orderBy("tie", "id").collect(), sorted(rows, key=lambda r: r[:2])), 1):
        cum, ids = cum + (v or 0), ids + i
        assert (have.tie, have.id, have["rank"], have.ids) == (tie, i, place, ids) and have.cum == pytest.approx(cum)
        assert have.ids_total == sum(r[1] for r in rows)
    assert slice_count(df) == spark.sparkContext.defaultParallelism
    assert running_total(df.limit(0), [F.col("id")], {"v": "cum"}).count() == 0


def test_hot_product_collapses_before_the_shuffle(spark):
    """A third of all sales on one product still leaves one row per product and day to move."""
    df = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), (F.col("id") % 50).cast("string"))).alias("product"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 20).alias("datetime"), F.lit(1.0).alias("amount"))
    assert "partial_sum" in plan(kpi.product_forecasts(df, 7))
    total = kpi.product_forecasts(df, 7).groupBy("product").count()
    assert total.count() == 51 and total.where("count <> 7").count() == 0


def test_bad_samples_limit_groups_before_the_shuffle(spark):
    df = spark.range(50_000)
    rule = Rule("id", "odd", "id < 0", "CAST(id AS STRING)", "never true")
    out = bad_samples(df, [rule])
    assert "WindowGroupLimit" in plan(out)
    assert out.first().sample_bad_values == ["0", "1", "10", "100", "1000"]


def test_scratch_follows_the_session(spark, tmp_path):
    old = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_dir(spark)
    if old is not None:
        assert scratch_dir(spark) == old.rstrip("/")


def test_materialise_keeps_schema_and_rows(spark, sf):
    part = table(spark, sf, "part")
    stored = materialise(part)
    assert stored.schema == part.schema and stored.exceptAll(part).count() == 0
