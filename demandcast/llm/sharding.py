"""Shards of nearly equal bytes by sampled splitters and range partitioning.

Records have a total order (digest of the text, key, row number), so that equal texts are
neighbours. Size-weighted samples of that order give quantile boundaries, and records are dealt to
the ranges between them. A range that still holds too many rows is subdivided by samples of its
own; the order has no ties, so one text with a third of all rows is split like any other range.
Exact sums of the ranges then place every record, which makes the result independent of the draw.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandcast.session import materialise

#: Ranges that one round makes of a range, and sampled keys for each of them.
FANOUT, PER_RANGE = 256, 16
#: Rows that one task sorts; a range over it is subdivided.
RANGE_ROWS = 500_000


def order_key(text: Column) -> Column:
    """First 60 bits of the text's MD5; NULL counts as the empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, 15), 16, 10).cast("long")


def _records(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, size, crc, at): narrow rows, written once so that the row number in ``at`` stays what it is."""
    whole = docs[f"`{text}`"]
    return materialise(docs.select(
        docs[f"`{key}`"].alias("key"), (F.coalesce(F.octet_length(whole), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(whole, F.lit("")).cast("binary")).alias("crc"), F.lit(0).cast("long").alias("part"),
        F.struct(order_key(whole).alias("h"), docs[f"`{key}`"].alias("k"), F.monotonically_increasing_id().alias("n")).alias("at")))


def _splitters(rows: DataFrame, wide: DataFrame, fanout: int, per_range: int, turn: int) -> DataFrame:
    """(part, cuts): quantiles of a sample of each range in ``wide`` (part, rows, bytes).

    A record is drawn by its share of the range's bytes and rows, about ``fanout * per_range``
    draws a range whatever its size. Draws hash the record, so a lost task draws the same again.
    """
    chance = F.pmod(F.xxhash64(F.lit(turn), "at"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    share = (F.col("size") / F.col("bytes") + F.lit(1.0) / F.col("rows")) / 2
    drawn = rows.join(F.broadcast(wide), "part").withColumn(
        "draws", F.floor(share * (fanout * per_range) + chance).cast("int")).where("draws > 0")
    sampled = drawn.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("at", "draws"))).alias("s"))
    # A heavy record counts as often as it was drawn.
    keys = F.flatten(F.transform("s", lambda x: F.array_repeat(x["at"], x["draws"])))
    cut = F.transform(F.sequence(F.lit(1), F.lit(fanout - 1)),
                      lambda i: F.element_at("keys", (F.floor(i * F.size("keys") / fanout) + 1).cast("int")))
    return sampled.select("part", keys.alias("keys")).select("part", F.array_distinct(cut).alias("cuts"))


def _below(cuts: Column, at: Column, fanout: int) -> Column:
    """How many cuts are at or before ``at``, by halving steps."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(fanout.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda found, step: F.when(
        F.try_element_at(cuts, found + step) <= at, found + step).otherwise(found))


def ranged(rows: DataFrame, fanout: int = FANOUT, per_range: int = PER_RANGE, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``rows`` with ``part``: ranges in the order of ``at``, none with more than ``range_rows`` rows."""
    for turn in range(8):
        sums = rows.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"))
        wide = materialise(sums.where(F.lit(turn == 0) | (F.col("rows") > range_rows)))
        if wide.isEmpty():
            return rows
        cuts = _splitters(rows, wide, fanout, per_range, turn)
        # One row per wide range: the planner broadcasts it as long as it is small.
        rows = materialise(rows.join(cuts, "part", "left").withColumn("part", F.col("part") * fanout + F.when(
            F.col("cuts").isNotNull(), _below(F.col("cuts"), F.col("at"), fanout)).otherwise(0)).select("key", "size", "crc", "part", "at"))
    raise RuntimeError("ranges did not become small")


def assign(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text", fanout: int = FANOUT,
           per_range: int = PER_RANGE, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 1 and the law is ``bytes``: a record goes to the shard
    in which the middle of its bytes lies when all records stand in order, so a shard is off its
    equal part by at most one record. ``slot`` counts from 0 in each shard, ``grown_shard`` is
    NULL. NULL texts are as empty ones (size 1, CRC of no bytes). Equal texts stand next to each
    other and are parted only where a shard ends. Rows are ordered by (digest, key, row); NULL keys come
    first; rows that repeat a key and text take slots of their own, in any order. An empty table gives no rows.
    """
    rows = ranged(_records(docs, key, text), fanout, per_range, range_rows)
    # One row per range: a few hundred, or the rows of the input over ``range_rows`` times the fan-out.
    sums = rows.groupBy("part").agg(F.sum("size").alias("bytes"))
    every = Window.partitionBy(F.lit(0))
    before = sums.select("part", (F.sum("bytes").over(every.orderBy("part")) - F.col("bytes")).alias("bytes_before"),
                         F.sum("bytes").over(every).alias("all_bytes"))
    inside = Window.partitionBy("part").orderBy("at")
    ends = F.col("bytes_before") + F.sum("size").over(inside)
    middle = 2 * ends - F.col("size")
    placed = materialise(rows.join(before, "part").select(
        "key", "size", "crc", "part", "at", middle.alias("middle"), "all_bytes").select(
        "key", "size", "crc", "part", "at",
        F.least(F.lit(shards - 1), F.expr(f"CAST(middle * {int(shards)} div (2 * all_bytes) AS INT)")).alias("shard")))
    # Slots: records of the shard in earlier ranges, then the place inside the range.
    held = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("rows"))
    earlier = held.select("shard", "part", (F.sum("rows").over(Window.partitionBy("shard").orderBy("part")) - F.col("rows")).alias("earlier"))
    place = F.row_number().over(Window.partitionBy("part", "shard").orderBy("at"))
    return placed.join(earlier, ["part", "shard"]).select(
        F.col("key").alias(key), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("earlier") + place - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, folder: str, shards: int = 16, key: str = "doc_id", text: str = "text", **sizes) -> DataFrame:
    """Write ``docs`` with all its columns below ``folder``, one sub-folder per shard, and return the assignment.

    Keys must be unique and not NULL; a key that repeats would give its row to every shard of the
    key, and raises. The files of a shard follow its slots. Each shard is written by many tasks: rows
    are dealt by ranges of (shard, slot).
    """
    placed = materialise(assign(docs, shards, key, text, **sizes))
    if placed.groupBy(key).count().where(F.col(key).isNull() | (F.col("count") > 1)).limit(1).count():
        raise ValueError("keys must be unique and not NULL to write shards")
    where = placed.select(F.col(key).alias("_key"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    rows = docs.join(where, docs[f"`{key}`"] == where["_key"]).repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot")
    rows.select(*[docs[f"`{c}`"] for c in docs.columns], F.col("_shard").alias("_in"), F.col("_slot").alias("_at")).write.partitionBy("_in").parquet(folder)
    return placed
