"""Running totals and exact quantiles over a global order, without a one-task window."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandcast.session import materialise


#: Bytes of input that one slice of a global order takes.
SLICE_BYTES = 64 << 20


def slice_count(df: DataFrame, slice_bytes: int = SLICE_BYTES) -> int:
    """Slices for an input of the planner's estimated size: at least one per core."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return min(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // slice_bytes)), 100_000)


def ordered_slices(df: DataFrame, order: Sequence[Column], values: dict[str, str], slices: int | None = None) -> DataFrame:
    """Range-partition and sort by ``order``; add ``_slice``, the row's place in it and running sums of ``values``.

    Slices follow the order, are balanced by sampled bounds, and split even a hot leading value as
    long as a later order column tells its rows apart. Sums run along the sorted rows of a
    task as they pass, so a slice is moved once and never regrouped. The result is written once,
    because slice totals and slice rows must come from the same bounds.
    """
    ranged = df.repartitionByRange(slices or slice_count(df), *order).sortWithinPartitions(*order)
    sums = {c: ("bigint" if df.schema[c].dataType.typeName() in ("byte", "short", "integer", "long") else "double") for c in values}
    types = {"bigint": pa.int64(), "double": pa.float64()}
    names = [*df.columns, *[f"_run_{values[c]}" for c in sums], "_slice", "_place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        rows, carried = 0, {c: pa.scalar(0, types[t]) for c, t in sums.items()}
        for batch in batches:
            columns, n = list(batch.columns), batch.num_rows
            for c, t in sums.items():
                if n:
                    run_ = pc.cumulative_sum(pc.fill_null(batch.column(c).cast(types[t]), 0), start=carried[c])
                    carried[c] = run_[n - 1]
                else:
                    run_ = pa.array([], types[t])
                columns.append(run_)
            columns += [pa.array([number] * n, pa.int32()), pa.array(range(rows + 1, rows + n + 1), pa.int64())]
            rows += n
            yield pa.RecordBatch.from_arrays(columns, names)

    fields = [*df.schema.fields, *[T.StructField(f"_run_{values[c]}", T.LongType() if t == "bigint" else T.DoubleType()) for c, t in sums.items()],
              T.StructField("_slice", T.IntegerType()), T.StructField("_place", T.LongType())]
    return materialise(ranged.mapInArrow(run, T.StructType(fields)))


def running_total(
    df: DataFrame, order: Sequence[Column], values: dict[str, str], rank: str | None = None,
    slices: int | None = None, totals: bool = False,
) -> DataFrame:
    """Add ``values[name] -> running sum of column name`` along a global total order.

    Each slice sums on its own; the totals of the slices before it (one row per slice) are
    added. ``rank`` also numbers the rows from 1; ``totals`` adds each grand total as
    ``<name>_total``. ``order`` should be a total order.
    """
    sliced = ordered_slices(df, order, values, slices)
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    per_slice = sliced.groupBy("_slice").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.max_by(f"_run_{out}", "_place").alias(f"_sum_{out}") for out in values.values()],
    )
    offsets = per_slice.select(
        F.col("_slice").alias("_of"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rows_before"),
        *[
            F.coalesce(F.sum(f"_sum_{out}").over(before), F.lit(0)).alias(f"_before_{out}")
            for out in values.values()
        ],
        *[F.sum(f"_sum_{out}").over(everything).alias(f"{out}_total") for out in values.values() if totals],
    )
    # One row per slice of a range shuffle, so this side is never larger than the task count.
    joined = sliced.join(F.broadcast(offsets), F.col("_slice") == F.col("_of"))
    extra = [F.col(f"{out}_total") for out in values.values() if totals] + [
        (F.col(f"_before_{out}") + F.col(f"_run_{out}")).alias(out) for out in values.values()]
    if rank:
        extra.append((F.col("_rows_before") + F.col("_place")).alias(rank))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *extra)


def exact_quantiles(df: DataFrame, value: str, qs: Sequence[float]) -> DataFrame:
    """Linear-interpolated quantiles of one column as rows ``(q, value)``.

    Equal values collapse to a count before any shuffle, the distinct values are ranked with
    :func:`running_total`, and only the two order statistics around each quantile survive.
    Memory stays flat where the built-in ``percentile`` keeps every distinct value of a group
    in one buffer.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    ranked = running_total(counts, [F.col("_v")], {"_c": "_upto"}, totals=True)
    wanted = F.array(*[F.lit(float(q)) for q in qs])
    near = (
        ranked.withColumn("q", F.explode(wanted))
        .withColumn("_pos", F.col("q") * (F.col("_upto_total") - 1))
        .withColumn("_low", F.floor("_pos"))
        .withColumn("_high", F.ceil("_pos"))
        .withColumn("_from", F.col("_upto") - F.col("_c"))
        .where((F.col("_from") <= F.col("_high")) & (F.col("_upto") > F.col("_low")))
    )
    return near.groupBy("q").agg(
        F.max(F.when((F.col("_from") <= F.col("_low")), F.col("_v"))).alias("_a"),
        F.max("_v").alias("_b"),
        F.max(F.col("_pos") - F.col("_low")).alias("_w"),
    ).select("q", (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_w")).alias("value"))
