"""Scans: CSV and Parquet tables, metric files, forecast files, file fingerprints."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandcast.functions.columns import col
from demandcast.session import materialise

METRIC_SCHEMA = "MAE double, RMSE double, MAPE double, sMAPE double, `COV_p10_p90_%` double"
FORECAST_SCHEMA = ("date date, product string, h int, y double, yhat double, yhat_p10 double, "
                   "yhat_p90 double, model string")


def read_features(spark: SparkSession, path: str, schema: str | T.StructType | None = None,
                  date: str = "date") -> DataFrame:
    """CSV panel with a required date column; give a schema to spare the inference pass."""
    reader = spark.read.option("header", True)
    df = (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
    if date not in df.columns:
        raise ValueError(f"column {date} is required")
    return df.withColumn(date, F.to_date(F.col(date).try_cast("timestamp")))


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def read_cached(spark: SparkSession, parquet: str, csv: str, schema: str | T.StructType | None = None) -> DataFrame:
    """The Parquet copy when there is one, else the raw CSV."""
    if path_exists(spark, parquet):
        return spark.read.parquet(parquet)
    if path_exists(spark, csv):
        reader = spark.read.option("header", True)
        return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(csv)
    raise FileNotFoundError(f"neither {parquet} nor {csv} exists")


def read_lenient(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """CSV scan whose whole-number columns come as nullable doubles, so gaps never fail."""
    reader = spark.read.option("header", True)
    df = (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
    whole = [f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)]
    return df.withColumns({c: F.col(f"`{c}`").cast("double") for c in whole}) if whole else df


def _named(df: DataFrame, suffix: str, out: str) -> DataFrame:
    name = F.regexp_extract(F.col("_metadata.file_name"), rf"^(.*){suffix}\.csv$", 1)
    return df.withColumn(out, name)


def _metric_files(spark: SparkSession, folder: str, suffix: str, columns: str) -> DataFrame:
    """Metric files of one kind, each column taken by its name in the header of its own file.

    Headers are few and short, so they are read first; files that agree on them are scanned
    together. A column that a file lacks is NULL, one that it has beyond the schema is left out.
    """
    found = spark.read.option("pathGlobFilter", f"*{suffix}.csv").option("wholetext", False).text(folder)
    first = found.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n"), "value").where(
        "at = 0").groupBy("path").agg(F.min_by("value", "n").alias("header"))
    by_header: dict[str, list[str]] = {}
    for r in first.collect():  # one row per metric file
        by_header.setdefault(r.header, []).append(r.path)
    out: DataFrame | None = None
    for header, paths in sorted(by_header.items()):
        names = [c.strip().strip('"') for c in header.split(",")]
        raw = spark.read.option("header", True).schema(", ".join(f"`{c}` string" for c in names)).csv(sorted(paths))
        wanted = [f.replace("`", "").rsplit(" ", 1) for f in columns.split(", ")]
        one = _named(raw.select("*", "_metadata"), suffix, "_model").select(
            *[(col(n).try_cast(t) if n in names else F.lit(None).cast(t)).alias(n) for n, t in wanted], F.col("_model").alias("model"))
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise FileNotFoundError(f"no metric files in {folder}")
    return out.where(~F.col("model").startswith("all_models"))


def read_overall_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Every ``<model>_metrics_overall.csv``, tagged with its model name."""
    try:
        return _metric_files(spark, folder, "_metrics_overall", METRIC_SCHEMA)
    except AnalysisException as e:
        raise FileNotFoundError(f"no metric files in {folder}") from e


def read_metrics_by_h(spark: SparkSession, folder: str) -> DataFrame:
    """Every ``<model>_metrics_by_h.csv``, tagged with its model name."""
    return _metric_files(spark, folder, "_metrics_by_h", f"h double, {METRIC_SCHEMA}").withColumn("h", F.col("h").cast("int"))


def read_forecasts(spark: SparkSession, folder: str, families: Sequence[str]) -> DataFrame:
    """Forecast files of the families that exist, in one table with a ``family`` column."""
    out: DataFrame | None = None
    for name in families:
        path = f"{folder.rstrip('/')}/{name}_forecasts.csv"
        if not path_exists(spark, path):
            continue
        # Files differ in their columns, so each header decides and the union lines them up.
        one = spark.read.option("header", True).csv(path)
        have = {c: t for c, t in (f.split(" ") for f in FORECAST_SCHEMA.split(", ")) if c in one.columns}
        one = one.select(*[F.col(c).try_cast(t).alias(c) for c, t in have.items()], F.lit(name).alias("family"))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError(f"no forecast files in {folder}")
    return out


#: Bytes of a block, and the size up to which a file is hashed whole.
BLOCK_BYTES, WHOLE_BYTES = 8 << 20, 256 << 20
#: Digests that one digest of the next level covers.
FAN_IN = 1024


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(path, file, length) of the files that are not empty; their content is not read."""
    return spark.read.format("binaryFile").load(path).select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "length")


def block_digests(files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(path, block, sha1) of every fixed block of the files; a task holds one block at a time.

    Blocks of one large file spread over all tasks, each opens the file where it needs it.
    """
    n = F.ceil(F.col("length") / block_bytes)
    blocks = files.select("path", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = []
            for path, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, inner = fs.FileSystem.from_uri(path if "://" in path else re.sub("^file:/*", "file:///", path))
                with system.open_input_file(inner) as f:
                    f.seek(block * block_bytes)
                    digests.append(hashlib.sha1(f.read(block_bytes)).hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.string())], ["path", "block", "sha1"])

    return blocks.repartition("path", "block").mapInArrow(run, "path string, block bigint, sha1 string")


def tree_digests(digests: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """(path, sha1): digests of up to ``fan_in`` neighbours joined to one, level by level, until each file has one.

    The digest of a level is the SHA-1 of the hex digests below it in order. A file of one block has that block's.
    """
    level = materialise(digests)
    while not level.groupBy("path").count().where("count > 1").isEmpty():
        up = level.groupBy("path", F.floor(F.col("block") / fan_in).alias("block")).agg(
            F.transform(F.sort_array(F.collect_list(F.struct("block", "sha1"))), lambda s: s["sha1"]).alias("_d"))
        many = level.groupBy(F.col("path").alias("_p")).agg((F.count(F.lit(1)) > 1).alias("_many"))
        level = materialise(up.join(many, F.col("path") == F.col("_p")).select(
            "path", "block", F.when(F.col("_many"), F.sha1(F.concat_ws("", "_d").cast("binary"))).otherwise(F.get("_d", F.lit(0))).alias("sha1")))
    return level.select("path", "sha1")


def file_fingerprints(spark: SparkSession, path: str, whole_bytes: int = WHOLE_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, sha1, length, method): ``whole`` files have the SHA-1 of their bytes, larger ones that of a tree over blocks."""
    files = file_sizes(spark, path)
    small = spark.read.format("binaryFile").load(path).where(F.col("length") <= whole_bytes).select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), F.sha1("content").alias("sha1"), "length", F.lit("whole").alias("method"))
    large = files.where(F.col("length") > whole_bytes)
    if large.isEmpty():
        return small
    tree = tree_digests(block_digests(large, block_bytes))
    return small.unionByName(large.join(tree, "path").select("file", "sha1", "length", F.lit("blocks").alias("method")))
