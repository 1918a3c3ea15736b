"""Embedding near-duplicates: random-hyperplane hashing, exact cosines, connected components.

Equal vectors are one class. Dense regions are covered by balls first: a ball's members lie
within half the link angle of its centre, so by the triangle inequality they are all linked with
each other and are counted, not enumerated. Hash tables then propose (vector, ball) pairs. The
exact angle to the centre decides most of them for the whole ball at once; only where centre
angle and radius leave it open are the ball's members compared one by one. A group of near
copies with a third of all vectors thus costs its size times a few balls.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandcast.llm.common import connected_components, map_arrow
from demandcast.session import materialise

#: A linked pair at exactly the threshold is proposed by no table with this probability.
MISS = 1e-3
#: Tables and bits that propose ball centres, and how often centres are looked for.
BALL_TABLES, BALL_BITS, BALL_ROUNDS = 6, 14, 3
SKETCH_BITS = 128
#: Standard deviations that a sketch may be off before a pair is dismissed.
SLACK = 5.0
#: Angles closer to a limit than this are decided by single cosines.
MARGIN = 1e-6


@lru_cache(maxsize=8)
def planes(dim: int, count: int) -> np.ndarray:
    """Random directions that depend on the dimension only."""
    return np.random.default_rng(7_000 + dim).standard_normal((count, dim)).T.copy()


def table_plan(n: int, cosine: float, miss: float = MISS) -> tuple[int, int]:
    """(bits, tables): buckets of a few vectors by chance, and enough tables for the recall."""
    bits = min(24, max(8, int(math.log2(max(n, 1) / 8)) if n > 8 else 8))
    hit = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - hit))


def _packed(bits: np.ndarray) -> np.ndarray:
    weights = np.uint64(1) << np.arange(bits.shape[-1], dtype=np.uint64)
    return (bits * weights).sum(axis=-1, dtype=np.uint64).view(np.int64)


def hashed(vectors: DataFrame, key: str, vector: str, bits: int, tables: int) -> DataFrame:
    """(id, unit, digest, keys, ball_keys, s0, s1); all NULL but the id for vectors that link with nothing."""
    total = bits * tables + BALL_TABLES * BALL_BITS + SKETCH_BITS
    fields = [("id", pa.int64()), ("unit", pa.list_(pa.float64())), ("digest", pa.binary()), ("keys", pa.list_(pa.int64())),
              ("ball_keys", pa.list_(pa.int64())), ("s0", pa.int64()), ("s1", pa.int64())]

    def usable(v) -> np.ndarray | None:
        if v is None or not len(v) or any(x is None for x in v):
            return None
        a = np.array(v, np.float64)
        return a if np.isfinite(a).all() and a.any() else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                out: list[list] = [[None] * batch.num_rows for _ in fields]
                out[0] = batch.column(0).to_pylist()
                found = [(i, usable(v)) for i, v in enumerate(batch.column(1).to_pylist())]
                by_dim: dict[int, list[tuple[int, np.ndarray]]] = {}
                for i, v in found:
                    if v is not None:
                        by_dim.setdefault(len(v), []).append((i, v))
                for dim, rows in by_dim.items():
                    m = np.array([v for _, v in rows])
                    m = m / np.abs(m).max(axis=1, keepdims=True)
                    unit = m / np.sqrt((m * m).sum(axis=1, keepdims=True))
                    side = unit @ planes(dim, total) >= 0
                    a, b = bits * tables, bits * tables + BALL_TABLES * BALL_BITS
                    keys = _packed(side[:, :a].reshape(-1, tables, bits))
                    balls = _packed(side[:, a:b].reshape(-1, BALL_TABLES, BALL_BITS))
                    sketch = _packed(side[:, b:].reshape(-1, 2, 64))
                    for j, (i, v) in enumerate(rows):
                        made = (unit[j], hashlib.blake2b(v.tobytes(), digest_size=16).digest(), keys[j] * 4096 + dim % 4096,
                                balls[j] * 4096 + dim % 4096, int(sketch[j, 0]), int(sketch[j, 1]))
                        for column, x in zip(out[1:], made):
                            column[i] = x
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(out, fields)], [n for n, _ in fields])

    source = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("v"))
    return map_arrow(source, run, "id bigint, unit array<double>, digest binary, keys array<bigint>, ball_keys array<bigint>, "
                                  "s0 bigint, s1 bigint")


def dot(a: str, b: str) -> Column:
    """Inner product of two unit vectors of one dimension; NULL if the dimensions differ."""
    return F.when(F.size(a) == F.size(b), F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x))


def _angle(cosine: Column) -> Column:
    return F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cosine)))


def _balls(classes: DataFrame, cosine: float) -> DataFrame:
    """(id, ball, angle): every class in one ball; a class alone is its own centre.

    In each round a class may join the smallest class of one of its buckets, if that one is near
    enough and joins no other. Bucket minima are combined map-side.
    """
    near = math.cos(math.acos(cosine) / 2 - MARGIN)
    open_ = classes.select("id", "ball_keys", "unit")
    placed = None
    for _ in range(BALL_ROUNDS):
        keys = open_.select("id", F.posexplode("ball_keys").alias("t", "k"))
        least = keys.groupBy("t", "k").agg(F.min("id").alias("centre"), F.count(F.lit(1)).alias("n")).where("n > 1")
        asked = keys.join(least, ["t", "k"]).where("id <> centre").select("id", "centre").distinct()
        near_enough = materialise(asked.join(open_.select("id", "unit"), "id").join(
            open_.select(F.col("id").alias("centre"), F.col("unit").alias("other")), "centre").select(
            "id", "centre", dot("unit", "other").alias("c")).where(F.col("c") >= near))
        roots = near_enough.select("centre").distinct().join(near_enough.select(F.col("id").alias("centre")), "centre", "left_anti")
        joined = near_enough.join(roots, "centre").groupBy("id").agg(F.min(F.struct("centre", "c")).alias("m")).select(
            "id", F.col("m.centre").alias("ball"), _angle(F.col("m.c")).alias("angle"))
        new = materialise(joined.unionByName(roots.select(F.col("centre").alias("id"), F.col("centre").alias("ball"), F.lit(0.0).alias("angle"))))
        placed = new if placed is None else placed.unionByName(new)
        if new.isEmpty():
            break
        open_ = open_.join(new.select("id"), "id", "left_anti")
        open_ = materialise(open_)
    return classes.select("id").join(placed, "id", "left").select(
        "id", F.coalesce("ball", "id").alias("ball"), F.coalesce("angle", F.lit(0.0)).alias("angle"))


def near_duplicates(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", cosine: float = 0.9) -> DataFrame:
    """(key, n_links, component_id, kept) for every row.

    Vectors are linked at ``cosine`` or more in double precision, whatever their other columns.
    ``n_links`` counts other rows linked directly, equal vectors included; ``component_id`` is the
    smallest key reachable by links, itself included. Vectors that are NULL, empty, zero, or
    hold NULL or non-finite components link with nothing, and so do vectors of different
    dimensions. A row with a NULL key is returned with no links and a NULL component. Keys are
    integers; rows that repeat a key and vector count as copies of each other.
    """
    bits, tables = table_plan(vectors.count(), cosine)
    rows = materialise(hashed(vectors, key, vector, bits, tables))
    some = rows.where("digest IS NOT NULL AND id IS NOT NULL")
    weights = some.groupBy("digest").agg(F.min("id").alias("leader"), F.count(F.lit(1)).alias("weight"))
    classes = materialise(some.join(weights.select(F.col("leader").alias("id"), "weight", F.col("digest").alias("_d")), "id").where(
        "digest = _d").drop("_d").dropDuplicates(["id", "digest"]))

    placed = _balls(classes, cosine)
    members = materialise(classes.join(placed, "id"))
    ball = members.groupBy("ball").agg(F.max("angle").alias("radius"), F.sum("weight").alias("ball_weight"))
    centres = materialise(members.where("id = ball").select(
        "ball", F.col("unit").alias("centre"), F.col("s0").alias("c0"), F.col("s1").alias("c1")).join(ball, "ball"))

    # Buckets: every vector against each ball that has a member there.
    limit = math.acos(cosine)
    share = F.least(F.lit(1.0), (F.lit(limit) + F.col("radius")) / math.pi)
    reach = SKETCH_BITS * share + SLACK * F.sqrt(SKETCH_BITS * share * (1 - share))
    spots = members.select("id", "ball", "s0", "s1", F.posexplode("keys").alias("t", "k"))
    there = members.select("ball", F.posexplode("keys").alias("t", "k")).distinct().join(
        centres.select("ball", "c0", "c1", reach.alias("reach")), "ball").select(
        "t", "k", F.col("ball").alias("other"), "c0", "c1", "reach")
    asked = materialise(spots.join(there, ["t", "k"]).where(
        (F.col("ball") != F.col("other"))
        & (F.bit_count(F.col("s0").bitwiseXOR(F.col("c0"))) + F.bit_count(F.col("s1").bitwiseXOR(F.col("c1"))) <= F.col("reach"))).select(
        "id", "other").distinct())
    angles = materialise(asked.join(members.select("id", "unit"), "id").join(
        centres.select(F.col("ball").alias("other"), "centre", "radius", "ball_weight"), "other").select(
        "id", "other", "radius", "ball_weight", dot("unit", "centre").alias("c")).withColumn("angle", _angle(F.col("c"))).where(
        F.col("angle") - F.col("radius") <= limit + MARGIN))
    # A ball of radius 0 is its centre alone: the cosine itself decides.
    alone = (F.col("radius") == 0) & (F.col("c") >= cosine)
    inside = (F.col("radius") > 0) & (F.col("angle") + F.col("radius") <= limit - MARGIN)
    whole = angles.where(alone | inside).select("id", F.col("other").alias("to"), F.col("ball_weight").alias("n"))
    singly = angles.where((F.col("radius") > 0) & ~inside).select("id", "other").join(members.select("id", "unit"), "id").join(
        members.select(F.col("ball").alias("other"), F.col("id").alias("y"), F.col("unit").alias("unit_y"), F.col("weight").alias("w")),
        "other").where(dot("unit", "unit_y") >= cosine).groupBy("id", "other").agg(F.min("y").alias("to"), F.sum("w").alias("n")).select(
        "id", "to", "n")
    linked = materialise(whole.unionByName(singly))

    edges = linked.select(F.col("id").alias("src"), F.col("to").alias("dst")).unionByName(
        members.where("id <> ball").select(F.col("id").alias("src"), F.col("ball").alias("dst")))
    groups = connected_components(edges)
    counts = members.join(ball.select("ball", "ball_weight"), "ball").join(
        linked.groupBy("id").agg(F.sum("n").alias("outside")), "id", "left").join(groups.withColumnRenamed("node", "id"), "id", "left").select(
        "digest", (F.col("ball_weight") - 1 + F.coalesce("outside", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    return rows.select("id", F.when(F.col("id").isNotNull(), F.col("digest")).alias("digest")).join(counts, "digest", "left").select(
        F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))
