"""Sinks: panel snapshot, forecasts, metrics, run log, registry, manifests."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandcast.constants import KEY_REPLACEMENTS, METRICS
from demandcast.functions.columns import col, safe_name
from demandcast.operators.clean import forecast_columns, random_sample
from demandcast.operators.metrics import metrics_by_h, metrics_overall


def schema_table(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(list(df.dtypes), "`column` string, dtype string")


def write_snapshot(df: DataFrame, folder: str, sample_rows: int = 1000, seed: int = 42) -> str:
    """Panel as Parquet, its schema and a small random sample as CSV."""
    art = f"{folder.rstrip('/')}/artifacts"
    df.write.mode("overwrite").parquet(f"{art}/df_final.parquet")
    stored = df.sparkSession.read.parquet(f"{art}/df_final.parquet")
    schema_table(df).write.mode("overwrite").csv(f"{art}/df_final_schema.csv", header=True)
    random_sample(stored, sample_rows, seed).write.mode("overwrite").csv(f"{art}/df_final_sample.csv", header=True)
    return art


def write_forecasts(forecasts: DataFrame, folder: str, target: str = "y") -> dict[str, str]:
    """Normalised forecasts and their metrics, partitioned by model so one family reads alone.

    A later run replaces only the models it holds.
    """
    root = folder.rstrip("/")
    paths = {n: f"{root}/{n}" for n in ("forecasts", "metrics_by_h", "metrics_overall")}
    tables = {"forecasts": forecast_columns(forecasts, target)}
    tables["metrics_by_h"] = metrics_by_h(tables["forecasts"])
    tables["metrics_overall"] = metrics_overall(tables["forecasts"])
    for n, t in tables.items():
        t.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model").parquet(paths[n])
    return paths


def write_enriched(df: DataFrame, folder: str, dictionary: Mapping[str, str]) -> dict[str, str]:
    """Enriched sales and their data dictionary as CSV."""
    root = folder.rstrip("/")
    df.write.mode("overwrite").csv(f"{root}/enriched", header=True)
    df.sparkSession.createDataFrame(list(dictionary.items()), "`column` string, description string").write.mode(
        "overwrite").csv(f"{root}/dictionary", header=True)
    return {"enriched": f"{root}/enriched", "dictionary": f"{root}/dictionary"}


def clean_key(c: str | Column) -> Column:
    """Metric or parameter name with the characters a run log cannot hold replaced."""
    out = col(c)
    for bad, good in KEY_REPLACEMENTS:
        out = F.replace(out, F.lit(bad), F.lit(good))
    return out


def run_log(overall: DataFrame, by_h: DataFrame, metrics: Sequence[str] = METRICS, model: str = "model") -> DataFrame:
    """Long table ``(run, key, step, value)``: overall metrics at step 0, per-horizon at step h.

    Values are rounded to six decimals; NULL metrics are not logged.
    """
    def melt(df: DataFrame, step: Column, suffix: str) -> DataFrame:
        have = [m for m in metrics if m in df.columns]
        rows = F.array(*[F.struct(F.lit(m + suffix).alias("key"), col(m).cast("double").alias("value")) for m in have])
        return df.select(F.col(model).alias("run"), step.alias("step"), F.inline(rows))

    log = melt(overall, F.lit(0), "").unionByName(melt(by_h, F.col("h").cast("int"), "_by_h"))
    return log.where(F.col("value").isNotNull()).select("run", clean_key("key").alias("key"), "step",
                                                        F.round("value", 6).alias("value"))


def parameter_log(spark: SparkSession, run: str, params: Mapping[str, object], tags: Mapping[str, object] | None = None) -> DataFrame:
    """Parameters and tags as text rows; plain scalars keep their own form."""
    rows = [(run, "param", str(k), None if v is None else str(v)) for k, v in params.items()]
    rows += [(run, "tag", str(k), str(v)) for k, v in (tags or {}).items()]
    return spark.createDataFrame(rows, "run string, kind string, key string, value string").withColumn(
        "key", clean_key("key"))


def new_run_id(params: Mapping[str, object]) -> str:
    """Time, digest of the parameters, and a random part, so that no two runs share an id."""
    blob = json.dumps(dict(params), sort_keys=True, default=str)
    return f"v{datetime.now(timezone.utc):%Y%m%d-%H%M%S}-{hashlib.sha1(blob.encode()).hexdigest()[:8]}-{uuid.uuid4().hex[:6]}"


def append_log(log: DataFrame, path: str) -> None:
    """Append rows, in folders by run id (where the log has one) and run."""
    log.write.mode("append").partitionBy(*[c for c in ("run_id", "run") if c in log.columns]).parquet(path)


def version_id(params: Mapping[str, object], stamp: str | Column, tag: str | None = None) -> Column:
    """``v<stamp>-<first 8 hex of SHA-1 of the sorted-key JSON>[-tag]``."""
    blob = json.dumps(dict(params), sort_keys=True, default=str)
    stamp = F.lit(stamp) if isinstance(stamp, str) else F.date_format(stamp, "yyyyMMdd-HHmmss")
    parts = [F.lit("v"), stamp, F.lit("-"), F.substring(F.sha1(F.lit(blob)), 1, 8)]
    return F.concat(*parts, *([F.lit(f"-{tag}")] if tag else []))


def write_manifest(spark: SparkSession, folder: str, model: str, version: str, meta: Mapping[str, object]) -> None:
    """One manifest row under ``model=../version=..``."""
    row = spark.createDataFrame([(model, version, json.dumps(dict(meta), default=str, sort_keys=True))],
                                "model string, version string, meta string")
    row = row.withColumns({"model": safe_name("model"), "version": safe_name("version")})
    row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model", "version").json(
        f"{folder.rstrip('/')}/models")


def list_versions(spark: SparkSession, folder: str, n: int = 10) -> DataFrame:
    """The last ``n`` stored versions."""
    schema = "meta string, model string, version string"
    return spark.read.schema(schema).json(f"{folder.rstrip('/')}/models").orderBy(
        F.desc("version"), F.desc("model")).limit(n).select("model", "version", "meta")


def write_registry(best: DataFrame, folder: str, horizon: int, metric: str = "sMAPE", artifact: str = "",
                   trained_at: str | None = None) -> None:
    """Single best-model entry as JSON; the versions behind it stay in the manifests."""
    stamp = F.lit(trained_at) if trained_at else F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss")
    entry = best.limit(1).select(F.struct(
        F.col("model").alias("name"), F.lit(artifact).alias("artifact"), F.lit(metric).alias("metric"),
        col(metric).cast("double").alias("score"), F.lit(horizon).alias("horizon"), stamp.alias("trained_at"),
    ).alias("best_model"))
    entry.write.mode("overwrite").json(f"{folder.rstrip('/')}/registry")


def write_features(features: DataFrame, folder: str) -> None:
    """Distinct names of the column ``feature`` as a CSV list, written where they are."""
    features.select("feature").distinct().write.mode("overwrite").csv(f"{folder.rstrip('/')}/features_selected", header=True)


def write_feature_list(spark: SparkSession, features: Sequence[str], folder: str) -> None:
    """The same for a list of names."""
    write_features(spark.createDataFrame([(f,) for f in features], "feature string"), folder)


def rename_single(spark: SparkSession, folder: str, target: str) -> None:
    """Move the only part file of a small written table to a path of its own, through the store's own file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    source = hadoop(folder)
    system = source.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = [f.getPath() for f in system.listStatus(source) if f.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise ValueError(f"{folder} has {len(parts)} part files")
    system.mkdirs(hadoop(target).getParent())
    system.rename(parts[0], hadoop(target))


def run_metadata(spark: SparkSession, params: Mapping[str, object], fingerprints: DataFrame) -> DataFrame:
    """Parameters of a run with the SHA-1 of every input file, one row per file."""
    blob = json.dumps(dict(params), sort_keys=True, default=str)
    return fingerprints.select("file", "sha1", F.lit(blob).alias("params"))
