"""Helpers shared by the corpus operators: inputs, cut points, bounded filters, components."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandcast.session import materialise

#: Bits of a hash filter: 2^23 bits are one megabyte, whatever the number of keys.
FILTER_BITS = 23
#: Rows of an Arrow batch of ``small_batches``: some 2 MB of documents of 2,000 characters.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Batches of at most ``BATCH_ROWS`` rows between Spark and its Python workers from now on, or of the session's own, smaller size.

    With Spark's 10,000 rows a task's whole part of a document table is one batch, which the
    executor, its worker and the reply hold at the same time.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def release() -> None:
    """Give memory that a task has freed back to the machine; allocators keep it for a worker's next task otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` whose workers find this package where the driver found it, and keep no freed memory.

    On a cluster the package is installed on the nodes or passed with ``--py-files``; the entry
    added here matters to sessions that were started from another folder of the same machine.
    """
    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = df.sparkSession.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (known, root) if x)
    return df.mapInArrow(tidy, schema)


def size_bytes(df: DataFrame) -> int:
    """Optimizer's size estimate of a scan, used to size shuffles to the input."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def hash_filter(keys: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """A fixed-size bitmap of hashed keys: at most 2^(bits-12) rows of 64 longs.

    Its size does not depend on the number of keys, so it may be broadcast; with more keys
    than bits it lets everything pass and the exact join that follows does the work.
    """
    slot = F.pmod(F.xxhash64(F.col(key)), F.lit(1 << bits))
    words = keys.select(slot.alias("_s")).groupBy(F.shiftright("_s", 6).alias("_w")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(_s & 63 AS INT))")).alias("_b"))
    return words.groupBy(F.shiftright("_w", 6).alias("_chunk")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.expr("CAST(_w & 63 AS INT)"), F.col("_b")))).alias("_m")).select(
        F.col("_chunk").alias("_fchunk"),
        F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.coalesce(F.element_at("_m", i), F.lit(0))).alias("_fbits"))


def keep_possible(big: DataFrame, key: str, flt: DataFrame, bits: int = FILTER_BITS, others: bool = False) -> DataFrame:
    """Rows of ``big`` whose key may be among the filter's keys (no false negatives), or all ``others``."""
    slot = F.pmod(F.xxhash64(big[f"`{key}`"]), F.lit(1 << bits))
    hit = big.join(F.broadcast(flt), F.shiftright(slot, 12) == flt["_fchunk"], "left" if others else "inner")
    word = F.element_at(flt["_fbits"], (F.shiftright(slot, 6).bitwiseAND(63) + 1).cast("int"))
    bit = F.call_function("shiftright", word, slot.bitwiseAND(63).cast("int")).bitwiseAND(1)
    return hit.where(F.coalesce(bit, F.lit(0)) == (0 if others else 1)).select(*[big[f"`{c}`"] for c in big.columns])


def drop_keys(big: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows of ``big`` whose key is not among the first column of ``keys``; NULL keys stay.

    Rows that the fixed-size filter clears, usually most, are never shuffled.
    """
    gone = materialise(keys.select(keys[keys.columns[0]].alias("_gone")).distinct())
    flt = hash_filter(gone, "_gone")
    maybe = keep_possible(big, key, flt)
    return keep_possible(big, key, flt, others=True).unionByName(maybe.join(gone, maybe[f"`{key}`"] == gone["_gone"], "left_anti"))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable id for every node of an edge list (``src``, ``dst`` of any one orderable type).

    Each round points every node at its smallest neighbour, follows the pointers twice, and
    contracts the edges along them, so that a path shrinks at least fourfold and a star
    vanishes at once. Minima are combined map-side and every join has unique keys on one
    side, so a hub with a third of all links is split by AQE. Edges are written to the shared
    folder between rounds: a lost executor re-reads files and the driver sees counts only.
    NULL ends are ignored; self-links make a node without links known. Returns (node, component).
    """
    edges = edges.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL")
    current = materialise(edges.where("src <> dst").select(
        F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct())
    alone = edges.where("src = dst").select(F.col("src").alias("node")).distinct()
    steps: list[DataFrame] = []
    for _ in range(max_rounds):
        if current.isEmpty():
            break
        both = current.select("src", "dst").union(current.select("dst", "src"))
        parent = both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("to")).select(
            "node", F.least("node", "to").alias("to"))
        parent = materialise(parent)
        for _ in range(2):
            parent = parent.alias("a").join(
                parent.alias("b").select(F.col("b.node").alias("to"), F.col("b.to").alias("top")), "to").select(
                "node", F.col("top").alias("to"))
        parent = materialise(parent)
        steps.append(parent)
        moved = current.join(parent.select(F.col("node").alias("src"), F.col("to").alias("s")), "src").join(
            parent.select(F.col("node").alias("dst"), F.col("to").alias("d")), "dst")
        current = materialise(moved.where("s <> d").select(
            F.greatest("s", "d").alias("src"), F.least("s", "d").alias("dst")).distinct())
    else:
        raise RuntimeError("components did not settle")
    if not steps:
        return alone.select("node", F.col("node").alias("component"))
    labels = steps[0].withColumnRenamed("to", "component")
    for step in steps[1:]:
        labels = labels.join(step.select(F.col("node").alias("component"), "to"), "component", "left").select(
            "node", F.coalesce("to", "component").alias("component"))
    rest = alone.join(labels.select("node"), "node", "left_anti")
    return labels.unionByName(rest.select("node", F.col("node").alias("component")))


def cross_cells(members: DataFrame, block: int) -> DataFrame:
    """(k, i, j, side, id, c): members of groups dealt to cells, so that every pair of a group's members
    with different labels meets in a cell.

    ``members`` has (k, id, c, w): group, member, label and weight, each (k, id) once. A group's members
    are split by hash into blocks of a weight of about ``block``; a label with over half of that has blocks of its own,
    which never meet each other. Cell (i, j) holds the members of the two blocks, ``side`` is a
    member's own block. Groups with one label are left out, and no task holds more than a cell.
    """
    labels = members.groupBy("k", "c").agg(F.sum("w").alias("w"))
    large = F.col("w") > block // 2
    plan = labels.groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.when(~large, F.col("w"))), F.lit(0)).alias("rest"),
        F.collect_list(F.when(large, F.struct("c", F.ceil(F.col("w") / block).cast("int").alias("b")))).alias("own")).where("n > 1").select(
        "k", F.concat(F.array_repeat(F.lit(None).cast("bigint"), F.ceil(F.col("rest") / block).cast("int")),
                      F.flatten(F.transform("own", lambda x: F.array_repeat(x["c"], x["b"])))).alias("owners"))
    at = F.array_position("owners", F.col("c"))
    count = F.when(at > 0, F.size(F.filter("owners", lambda x: x == F.col("c")))).otherwise(
        F.size(F.filter("owners", lambda x: x.isNull())))
    first = F.when(at > 0, at - 1).otherwise(0)
    placed = members.join(plan, "k").withColumn("own", F.when(at > 0, F.col("c"))).withColumn(
        "side", (first + F.pmod(F.xxhash64("id"), count)).cast("int"))
    return placed.select("k", "id", "c", "own", "side", F.posexplode("owners").alias("other", "owner")).where(
        "owner IS NULL OR own IS NULL OR owner <> own").select(
        "k", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "id", "c")


def joining(a: list, b: list) -> list[int]:
    """Positions of pairs of labels that join what the pairs before them have not joined."""
    up: dict = {}
    out = []

    def top(x):
        while up.get(x, x) != x:
            up[x] = x = up.get(up[x], up[x])
        return x

    for n, (x, y) in enumerate(zip(a, b)):
        x, y = top(x), top(y)
        if x != y:
            up[x] = y
            out.append(n)
    return out
