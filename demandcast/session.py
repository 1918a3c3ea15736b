"""Session helpers: a tuned builder, the shared scratch folder, and materialised tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "demandcast", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are planned for.

    AQE sizes the shuffles and splits skewed join partitions at run time, so no partition
    count is fixed here; a caller on a laptop passes ``spark.sql.shuffle.partitions``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Recording a call site per column call dominates the building of wide plans.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def local_table(spark: SparkSession, rows: Sequence[tuple], **types: pa.DataType) -> DataFrame:
    """A small driver-side table (recipes, rule names) whose size the planner knows.

    Rows handed over as Arrow become a local relation; plain Python rows would be an RDD of
    unknown size, which joins by sort-merge.
    """
    schema = pa.schema(list(types.items()))
    columns = list(zip(*rows)) if rows else [()] * len(types)
    return spark.createDataFrame(pa.table([pa.array(c, t) for c, t in zip(columns, types.values())], schema=schema))


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for cut points, from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of its own: on a cluster a
    machine-local path would be invisible to the other executors.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    known = getattr(spark, "_demandcast_scratch", None)
    if known is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        known = tempfile.mkdtemp(prefix="demandcast-")
        atexit.register(shutil.rmtree, known, ignore_errors=True)
        spark._demandcast_scratch = known
    return known


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared folder for one written table."""
    return f"{scratch_dir(spark)}/tables/{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where one result feeds several branches: the expensive upstream runs once, both
    branches see the same rows, and a lost executor re-reads files instead of replaying the
    lineage. Parquet keeps column pruning and real size statistics for the join planner.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
