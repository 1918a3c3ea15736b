"""Scans and sinks over the given tables: write to the shared folder, read back through the operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import BASELINES, PANEL0, TX, metric_sql, panel, plain, query, sales, shown, table
from catalog.backtests import backtest
from demandcast.operators import clean
from demandcast.operators.metrics import metrics_by_h, metrics_overall
from demandcast.operators.selection import model_ranking
from demandcast.session import materialise, scratch_path
from demandcast.sources import readers, writers

M4 = "MAE RMSE MAPE sMAPE"


def _csv(df, path: str) -> str:
    df.write.csv(path, header=True)
    return path


@query("scan_features_csv", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, ROUND(o_totalprice, 2) AS y FROM orders")
def _(spark, sf):
    raw = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("y"))
    return plain(readers.read_features(spark, _csv(raw, scratch_path(spark)), "o_orderkey bigint, date string, y double"), money=["y"])


@query("scan_cached_copy", "SELECT 'csv' AS origin, COUNT(*) AS n, SUM(c_custkey) AS keys FROM customer UNION ALL SELECT 'parquet', COUNT(*), SUM(c_custkey) FROM customer WHERE c_custkey % 2 = 0")
def _(spark, sf):
    """Without a Parquet copy the CSV is read; with one (here of half the rows) the copy wins."""
    rows = table(spark, sf, "customer").select("c_custkey", "c_name")
    csv, copy = _csv(rows, scratch_path(spark)), scratch_path(spark)
    rows.where("c_custkey % 2 = 0").write.parquet(copy)
    total = lambda df, name: df.agg(F.lit(name).alias("origin"), F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("keys"))
    first = readers.read_cached(spark, f"{copy}-none", csv, "c_custkey bigint, c_name string")
    return total(first, "csv").unionByName(total(readers.read_cached(spark, copy, csv), "parquet"))


@query("scan_lenient_csv", "SELECT CAST(p_partkey AS DOUBLE) AS p_partkey, CASE WHEN p_partkey % 3 > 0 THEN CAST(p_size AS DOUBLE) END AS p_size, p_type FROM part")
def _(spark, sf):
    """Whole numbers with gaps come as doubles."""
    rows = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_partkey") % 3 > 0, F.col("p_size")).alias("p_size"), "p_type")
    return readers.read_lenient(spark, _csv(rows, scratch_path(spark)), "p_partkey bigint, p_size int, p_type string")


@query("scan_forecast_files", f"WITH {PANEL0}, {BASELINES} SELECT model AS family, model, product, h, CAST(date AS VARCHAR) AS date, ROUND(y, 6) + 0.0 AS y, ROUND(yhat, 6) + 0.0 AS yhat FROM fc WHERE model <> 'naive1'")
def _(spark, sf):
    """Two families in files of their own, a third named but absent."""
    fc = clean.forecast_columns(backtest(spark, sf)[2])
    root = scratch_path(spark)
    for name in ("ma7", "snaive7"):
        fc.where(F.col("model") == name).drop("yhat_p10", "yhat_p90").write.csv(f"{root}/{name}_forecasts.csv", header=True)
    got = readers.read_forecasts(spark, root, ["ma7", "snaive7", "gone"])
    return plain(got.select("family", "model", "product", "h", "date", "y", "yhat"))


@query("sink_forecasts_and_metrics", f"WITH {PANEL0}, {BASELINES}, m AS ({metric_sql('model', 'h')}) " + shown("model h", M4, "m"))
def _(spark, sf):
    """Metrics by horizon as stored next to the forecasts."""
    paths = writers.write_forecasts(backtest(spark, sf)[2], scratch_path(spark))
    return plain(spark.read.parquet(paths["metrics_by_h"]).select("model", "h", *M4.split()))


@query("sink_snapshot", """WITH b AS (SELECT p_type, CAST(l_shipdate AS DATE) AS d FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
 SELECT COUNT(*) AS n_rows, LEAST(COUNT(*), 1000) AS n_sample, CAST(4 AS BIGINT) AS n_columns, CAST(0 AS BIGINT) AS n_foreign FROM b""")
def _(spark, sf):
    """Rows of the stored panel, of its sample and its schema; sampled rows are rows of the panel."""
    art = writers.write_snapshot(panel(spark, sf), scratch_path(spark))
    full = spark.read.parquet(f"{art}/df_final.parquet")
    part = spark.read.csv(f"{art}/df_final_sample.csv", header=True).withColumn("date", F.to_date("date"))
    schema = spark.read.csv(f"{art}/df_final_schema.csv", header=True)
    foreign = part.join(full, ["product", "date"], "left_anti")
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    return one(full, "n_rows").join(one(part, "n_sample")).join(one(schema, "n_columns")).join(one(foreign, "n_foreign"))


@query("sink_enriched_sales", f"WITH {TX} SELECT event_id, product, ROUND(amount, 2) AS amount, 'what was sold' AS meaning FROM tx")
def _(spark, sf):
    paths = writers.write_enriched(sales(spark, sf).select("event_id", "product", "amount"), scratch_path(spark), {"product": "what was sold"})
    words = spark.read.csv(paths["dictionary"], header=True).select(F.col("description").alias("meaning"))
    rows = spark.read.schema("event_id bigint, product string, amount double").csv(paths["enriched"], header=True)
    return plain(rows.join(F.broadcast(words)), money=["amount"])


@query("sink_registry", f"""WITH {PANEL0}, {BASELINES}, m AS ({metric_sql('model')})
 SELECT model AS name, ROUND(sMAPE, 6) AS score, CAST(7 AS BIGINT) AS horizon, 'sMAPE' AS metric FROM m ORDER BY sMAPE, model LIMIT 1""")
def _(spark, sf):
    root = scratch_path(spark)
    best = model_ranking(metrics_overall(backtest(spark, sf)[2]))
    writers.write_registry(best.orderBy("rank"), root, 7)
    return plain(spark.read.json(f"{root}/registry").select("best_model.name", "best_model.score", "best_model.horizon", "best_model.metric"))


@query("version_ids", """SELECT o_orderkey, 'v' || strftime(o_orderdate, '%Y%m%d-%H%M%S') || '-' || substr(sha1('{"alpha": 1, "beta": "x"}'), 1, 8) || '-t' AS version FROM orders""")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", writers.version_id({"beta": "x", "alpha": 1}, F.col("o_orderdate"), "t").alias("version"))


@query("manifest_listing", """WITH v AS (SELECT 'v' || strftime(MAX(o_orderdate), '%Y%m%d') AS version, MAX(o_custkey) AS top FROM orders GROUP BY year(o_orderdate))
 SELECT 'm_1' AS model, version, '{"top": ' || top || '}' AS meta FROM v ORDER BY version DESC LIMIT 3""")
def _(spark, sf):
    """One manifest per order year; the newest three are listed."""
    root = scratch_path(spark)
    years = table(spark, sf, "orders").groupBy(F.year("o_orderdate")).agg(
        F.concat(F.lit("v"), F.date_format(F.max("o_orderdate"), "yyyyMMdd")).alias("version"), F.max("o_custkey").alias("top"))
    for r in years.collect():  # a handful of versions
        writers.write_manifest(spark, root, "m 1", r.version, {"top": r.top})
    return writers.list_versions(spark, root, 3)


@query("feature_list_file", "SELECT DISTINCT p_type AS feature FROM part")
def _(spark, sf):
    root = scratch_path(spark)
    writers.write_features(table(spark, sf, "part").select(F.col("p_type").alias("feature")), root)
    return spark.read.csv(f"{root}/features_selected", header=True)


@query("scan_metric_files", f"WITH {PANEL0}, {BASELINES}, m AS ({metric_sql('model')}), h AS ({metric_sql('model', 'h')}) " +
       "SELECT model, CAST(NULL AS INTEGER) AS h, " + ", ".join(f"ROUND({c}, 6) + 0.0 AS {c}" for c in M4.split()) + " FROM m UNION ALL SELECT model, h, " +
       ", ".join(f"ROUND({c}, 6) + 0.0 AS {c}" for c in M4.split()) + " FROM h")
def _(spark, sf):
    """One file per model, each with its columns in another order; the pooled file is left out."""
    fc = materialise(backtest(spark, sf)[2])
    root = scratch_path(spark)
    for i, name in enumerate(("naive1", "snaive7", "ma7")):
        own = fc.where(F.col("model") == name)
        columns = M4.split()[i:] + M4.split()[:i]
        metrics_overall(own).select(*columns).coalesce(1).write.csv(f"{root}/o{i}", header=True)
        metrics_by_h(own).select(*columns, "h", F.lit("more").alias("note")).coalesce(1).write.csv(f"{root}/h{i}", header=True)
        writers.rename_single(spark, f"{root}/o{i}", f"{root}/all/{name}_metrics_overall.csv")
        writers.rename_single(spark, f"{root}/h{i}", f"{root}/all/{name}_metrics_by_h.csv")
    metrics_overall(fc).select(*M4.split()).limit(1).coalesce(1).write.csv(f"{root}/pooled", header=True)
    writers.rename_single(spark, f"{root}/pooled", f"{root}/all/all_models_metrics_overall.csv")
    overall = readers.read_overall_metrics(spark, f"{root}/all").withColumn("h", F.lit(None).cast("int"))
    return plain(overall.unionByName(readers.read_metrics_by_h(spark, f"{root}/all")).select("model", "h", *M4.split()))


@query("block_fingerprints", """WITH t AS (SELECT n_nationkey, n_name || chr(10) AS s FROM nation),
 b AS (SELECT n_nationkey, length(s) AS n, i, sha1(substr(s, CAST(4 * i + 1 AS BIGINT), 4)) AS d FROM t, (SELECT UNNEST(generate_series(0, 20)) AS i) WHERE 4 * i < length(s))
 SELECT n_nationkey, CASE WHEN n <= 4 THEN ANY_VALUE(d) ELSE sha1(string_agg(d, '' ORDER BY i)) END AS sha1 FROM b GROUP BY n_nationkey, n""")
def _(spark, sf):
    """Blocks of four bytes of one small file per nation, joined to a digest per file."""
    root = scratch_path(spark)
    names = table(spark, sf, "nation").select("n_nationkey", "n_name")
    names.withColumn("k", F.col("n_nationkey")).repartition("n_nationkey").select("k", "n_name").write.partitionBy("k").text(root)
    files = readers.file_sizes(spark, f"{root}/k=*/*.txt")
    digests = readers.tree_digests(readers.block_digests(files, 4))
    return digests.select(F.regexp_extract("path", r"k=(\d+)/", 1).cast(names.schema["n_nationkey"].dataType).alias("n_nationkey"), "sha1")


@query("run_fingerprints", "SELECT n_nationkey, sha1(n_name || chr(10)) AS sha1, CAST(length(n_name) + 1 AS BIGINT) AS length FROM nation")
def _(spark, sf):
    """One text file per nation, found again by its digest."""
    root = scratch_path(spark)
    names = table(spark, sf, "nation").select("n_nationkey", "n_name")
    names.withColumn("k", F.col("n_nationkey")).repartition("n_nationkey").select("k", "n_name").write.partitionBy("k").text(root)
    files = readers.file_fingerprints(spark, f"{root}/k=*/*.txt")
    return names.join(files.withColumnRenamed("sha1", "digest"), F.sha1(F.encode(F.concat("n_name", F.lit("\n")), "UTF-8")) == F.col("digest")).select(
        "n_nationkey", F.col("digest").alias("sha1"), "length")


@query("time_synonyms", "SELECT o_orderkey, CAST(o_orderdate AS VARCHAR) AS datetime FROM orders")
def _(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("string").alias("timestamp"), F.lit("1999-01-01").alias("date"))
    return plain(clean.resolve_datetime(rows).select("o_orderkey", "datetime"))


@query("random_sample_of_orders", "SELECT LEAST(COUNT(*), 500) AS n, CAST(0 AS BIGINT) AS foreign_rows, LEAST(COUNT(*), 500) AS n_distinct FROM orders")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    part = clean.random_sample(orders, 500).persist()
    return part.join(orders.withColumn("known", F.lit(1)), "o_orderkey", "left").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("known").isNull(), 1).otherwise(0)).alias("foreign_rows"), F.count_distinct("o_orderkey").alias("n_distinct"))


@query("schema_report", """SELECT * FROM (VALUES ('o_orderkey', TRUE, 'bigint', 'bigint'), ('o_totalprice', TRUE, 'double', 'double'), ('lost', FALSE, 'int', 'MISSING'))
 AS v("column", "exists", expected, inferred_dtype)""")
def _(spark, sf):
    return clean.schema_report(table(spark, sf, "orders"), {"o_orderkey": "bigint", "o_totalprice": "double", "lost": "int"})


@query("sequence_channels", "SELECT UNNEST(['y', 'revenue']) AS channel, (SELECT ROUND(SUM(l_extendedprice), 2) FROM lineitem) AS total")
def _(spark, sf):
    """Numeric channels of the panel, the target first, with the revenue they are read from."""
    p = panel(spark, sf)
    channels = clean.sequence_features(p)
    assert channels[0] == clean.pick_numeric(p, "y")
    return plain(p.agg(F.sum("revenue").alias("total")).select(F.explode(F.array(*[F.lit(c) for c in channels])).alias("channel"), "total"), money=["total"])
