"""Series packed into one row each, for fits that run as array operations inside tasks.

A series has at most one row per calendar day, whatever the number of raw sales, so a packed
series is bounded by the calendar. Packing costs the one exchange that brings a series together;
models that sum over all series then return sums per task, not rows.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from demandcast.functions.columns import col, no_nan
from demandcast.session import materialise

EPOCH = np.datetime64("1970-01-01")


def pack(panel: DataFrame, columns: Sequence[str], key: Sequence[str] = ("product",), time: str = "date") -> DataFrame:
    """(key, days, rows): sorted day numbers of each series and its ``columns`` row by row, NULL and NaN as NULL.

    Series are dealt evenly over the tasks, so that every later pass over them is balanced.
    """
    values = F.array(*[no_nan(col(c).cast("double")) for c in columns])
    listed = panel.where(F.col(time).isNotNull()).groupBy(*key).agg(
        F.sort_array(F.collect_list(F.struct(F.unix_date(F.col(time)).alias("d"), values.alias("v")))).alias("_r"))
    flat = listed.select(*key, F.transform("_r", lambda r: r["d"]).alias("days"), F.flatten(F.transform("_r", lambda r: r["v"])).alias("rows"))
    spark = panel.sparkSession
    return materialise(flat.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))))


def map_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` whose workers find this package where the driver found it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = df.sparkSession.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (known, root) if x)
    return df.mapInArrow(run, schema)


def each_series(batches: Iterator[pa.RecordBatch], n_columns: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(one-row batch, days, rows x columns) of every packed series; NULL is NaN."""
    for batch in batches:
        days, rows = batch.column("days"), batch.column("rows")
        for i in range(batch.num_rows):
            d = days[i].values.to_numpy(zero_copy_only=False)
            x = rows[i].values.to_numpy(zero_copy_only=False).astype(float).reshape(len(d), n_columns)
            yield batch.slice(i, 1), d, x


def fill_forward_back(x: np.ndarray) -> np.ndarray:
    """Last known value of each column, before the first one that one; all NaN stays NaN."""
    known = ~np.isnan(x)
    at = np.where(known, np.arange(len(x))[:, None], -1)
    last = np.maximum.accumulate(at, axis=0)
    first = np.argmax(known, axis=0)
    take = np.where(last < 0, first[None, :], last)
    return np.take_along_axis(x, take, axis=0)


def day_number(date) -> int:
    return int((np.datetime64(date) - EPOCH).astype(int))


def origin_days(origins: DataFrame) -> list[tuple[int, int, int, int]]:
    """(origin_id, train_end, test_start, test_end) as day numbers; a handful of rows."""
    rows: list[Row] = origins.orderBy("origin_id").collect()
    return [(r.origin_id, day_number(r.train_end), day_number(r.test_start), day_number(r.test_end)) for r in rows]
