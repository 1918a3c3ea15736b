"""Hard negatives by rotated one-bit codes: popcounts give an interval, open intervals are scored.

A vector is rotated and split along the signs of its components; what that leaves is rotated and
split again, a few times. Stored are the sign bits, the alignment of every vector with its code
and the length. An anchor is rotated alike and rounded to a few bit planes. Popcounts of plane
and code add up to an estimate of the inner product, and Cauchy-Schwarz on what codes and rounding
left out gives a width that no pair exceeds. Only pairs whose interval reaches what is still
wanted are scored, in integers, so the result is that of all pairs.

Anchors are a stated set of queries. They come in blocks of bounded size, which are broadcast; the
rows are read in place, and every task returns the few best rows of each query.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandcast.llm.common import map_arrow
from demandcast.session import materialise, scratch_path

#: Rotations and codes a vector has; each leaves about 0.6 of the length before.
CODES = 4
#: Bits of an anchor's rounded components.
PLANES = 6
#: Anchors of a block, and rows that one task reads.
BLOCK, TASK_ROWS = 2_048, 262_144
#: Rows and anchors whose intervals are held at a time.
ROWS_AT, ANCHORS_AT = 2_048, 64
#: Below this, sums of doubles are exact integers.
EXACT = 2.0 ** 53
LARGEST = np.iinfo(np.int64)


def width(dim: int) -> int:
    """Bits of one code: the next power of two, 64 at least."""
    return max(64, 1 << (dim - 1).bit_length())


def rotate(x: np.ndarray, turn: int) -> np.ndarray:
    """Rows turned by the rotation of this number: random signs and Hadamard transforms, twice."""
    n, d = x.shape
    rng = np.random.default_rng([turn, d])
    for _ in range(2):
        x = x * rng.choice([-1.0, 1.0], d)
        step = 1
        while step < d:
            y = x.reshape(n, -1, 2, step)
            x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], axis=2).reshape(n, d)
            step *= 2
        x = x / np.sqrt(d)
    return x


def padded(vectors: np.ndarray) -> np.ndarray:
    n, d = vectors.shape
    return np.hstack([vectors, np.zeros((n, width(d) - d))])


def packed(bits: np.ndarray) -> np.ndarray:
    """(rows, words) of 64 bits each."""
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def encode(vectors: np.ndarray, codes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bits, alignments, lengths): codes side by side, the cosine of each residual with its code, and the vector's length."""
    x = padded(vectors)
    length = np.sqrt((x * x).sum(axis=1))
    rest, bits, aligned = length, [], []
    for turn in range(codes):
        x = rotate(x, turn)
        up = x >= 0
        side = np.abs(x).mean(axis=1)
        cosine = np.divide(side * np.sqrt(x.shape[1]), rest, out=np.zeros(len(x)), where=rest > 0)
        bits.append(packed(up))
        aligned.append(np.clip(cosine, 0, 1))
        x = x - np.where(up, side[:, None], -side[:, None])
        rest = np.sqrt((x * x).sum(axis=1))
    return np.hstack(bits), np.stack(aligned, axis=1), length


@dataclass
class Anchors:
    """Anchors of one dimension with their rounded rotations."""

    at: np.ndarray  # position in the block
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    length: np.ndarray
    planes: list[np.ndarray]  # per code: (anchors, planes, words)
    step: list[np.ndarray]  # per code: value of the lowest plane
    total: list[np.ndarray]  # per code: sum of the rounded components
    off: list[np.ndarray]  # per code: sum of what rounding changed


def round_anchors(at: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, codes: int, planes: int) -> Anchors:
    x = padded(vectors)
    made = Anchors(at, ids, labels, vectors, np.sqrt((x * x).sum(axis=1)), [], [], [], [])
    half = 1 << (planes - 1)
    for turn in range(codes):
        x = rotate(x, turn)
        step = np.abs(x).max(axis=1) / (half - 1)
        step[step == 0] = 1.0
        z = np.rint(x / step[:, None])
        whole = (z + half).astype(np.int64)
        made.planes.append(np.stack([packed((whole >> j & 1).astype(bool)) for j in range(planes)], axis=1))
        made.step.append(step)
        made.total.append(z.sum(axis=1))
        made.off.append(np.abs(x - z * step[:, None]).sum(axis=1))
    return made


def intervals(a: Anchors, rows: slice, bits: np.ndarray, aligned: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bound of the inner products of anchors and coded rows."""
    codes = aligned.shape[1]
    words = bits.shape[1] // codes
    dim = 64 * words
    rest = length
    middle = np.zeros((rows.stop - rows.start, len(bits)))
    wide = np.zeros_like(middle)
    for turn in range(codes):
        code = bits[:, turn * words:(turn + 1) * words]
        planes = a.planes[turn][rows]
        n_planes = planes.shape[1]
        both = np.zeros(middle.shape, np.int32)
        ones = np.zeros(len(bits), np.int32)
        for w in range(words):
            ones += np.bitwise_count(code[:, w])
            for j in range(n_planes):
                both += np.bitwise_count(planes[:, j, w][:, None] & code[:, w][None, :]).astype(np.int32) << j
        # Sum of rounded components under the signs of the code.
        signed = 2.0 * (both - (ones << (n_planes - 1))) - a.total[turn][rows][:, None]
        signed *= a.step[turn][rows][:, None]
        side = aligned[:, turn] * rest / np.sqrt(dim)
        middle += side * signed
        wide += side * a.off[turn][rows][:, None]
        rest = rest * np.sqrt(1 - aligned[:, turn] ** 2)
        if turn == codes - 1:
            # What is left is at right angles to the last code, so only the anchor's part beside it counts.
            along = np.maximum(0.0, np.abs(signed) - a.off[turn][rows][:, None])
            wide += rest * np.sqrt(np.maximum(0.0, a.length[rows][:, None] ** 2 - along ** 2 / dim))
    wide += 1e-6 * a.length[rows][:, None] * length + 1e-6
    return middle - wide, middle + wide


def integer_scores(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray, size: float) -> np.ndarray:
    """Inner products of the rows ``i`` of ``left`` and ``j`` of ``right``, whole numbers held as doubles."""
    if size >= EXACT:
        exact = [sum(int(x) * int(y) for x, y in zip(left[a], right[b])) for a, b in zip(i, j)]
        return np.array([min(max(s, LARGEST.min + 1), LARGEST.max) for s in exact], np.int64)
    if 4 * len(i) > len(left) * len(right):
        return (left @ right.T)[i, j].astype(np.int64)
    out = np.empty(len(i), np.int64)
    for at in range(0, len(i), 65_536):
        piece = slice(at, at + 65_536)
        out[piece] = np.einsum("nd,nd->n", left[i[piece]], right[j[piece]])
    return out


def best_of(query: np.ndarray, score: np.ndarray, row: np.ndarray, keep: int) -> np.ndarray:
    """Positions of the ``keep`` highest scores of each query, equal ones by ascending id; sorted by query."""
    order = np.lexsort((row, -score, query))
    group = query[order]
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, np.int64)
    rank = np.arange(len(group)) - np.repeat(first, np.diff(np.r_[first, len(group)]))
    return order[rank < keep]


def coded(vectors: DataFrame, key: str, vector: str, label: str, scale: int, codes: int) -> DataFrame:
    """(id, label, dim, v, bits, aligned, length) of the rows that take part, equal rows once; ``v`` holds whole numbers as doubles."""
    fields = [("id", pa.int64()), ("label", pa.int64()), ("dim", pa.int32()), ("v", pa.binary()), ("bits", pa.binary()),
              ("aligned", pa.binary()), ("length", pa.float64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                ids, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                by_dim: dict[int, list[tuple[int, np.ndarray]]] = {}
                for i, v in enumerate(batch.column(2).to_pylist()):
                    if not v or ids[i] is None or labels[i] is None or any(x is None for x in v):
                        continue
                    with np.errstate(over="ignore"):
                        scaled = np.floor(scale * np.array(v, np.float64))
                    if np.isfinite(scaled).all():
                        by_dim.setdefault(len(v), []).append((i, scaled))
                for dim, rows in by_dim.items():
                    m = np.array([v for _, v in rows]) + 0.0  # no negative zero
                    bits, aligned, length = encode(m, codes)
                    columns = [[ids[i] for i, _ in rows], [labels[i] for i, _ in rows], [dim] * len(rows), [x.tobytes() for x in m],
                               [x.tobytes() for x in bits], [x.tobytes() for x in aligned], length]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])

    source = vectors.select(vectors[f"`{key}`"].cast("long").alias("id"), vectors[f"`{label}`"].cast("long").alias("label"),
                            vectors[f"`{vector}`"].cast("array<double>").alias("v"))
    return map_arrow(source, run, "id bigint, label bigint, dim int, v binary, bits binary, aligned binary, length double").dropDuplicates(["id", "label", "v"])


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(ids, labels, vectors, bits, aligned, length) of the batch's rows of each dimension."""
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims):
        part = batch.filter(pa.array(dims == dim))
        n = part.num_rows

        def grid(name: str, kind: type) -> np.ndarray:
            return np.frombuffer(b"".join(part.column(name).to_pylist()), kind).reshape(n, -1)

        yield (part.column("id").to_numpy(), part.column("label").to_numpy(), grid("v", np.float64), grid("bits", np.uint64),
               grid("aligned", np.float64), part.column("length").to_numpy())


def _best_rows(rows: DataFrame, shared, per_anchor: int, keep: int, same: bool) -> DataFrame:
    """(query, score, id): per task the best rows of each query of a block.

    ``shared`` holds the anchors by dimension and, per anchor, ``per_anchor`` wanted ranges of
    scores (an empty range has its lower end above its upper one). Rows have the anchor's label
    and another id (``same``), or another label.
    """
    fields = [("query", pa.int64()), ("score", pa.int64()), ("id", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, low, high = shared.value
        best = [np.zeros(0, np.int64)] * 3
        floor = low.copy()  # per query: what a row must reach
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT):
                for ids, labels, vectors, bits, aligned, length in _matrices(whole.slice(at, ROWS_AT)):
                    a = anchors.get(vectors.shape[1])
                    if a is None:
                        continue
                    found: list[list[np.ndarray]] = [[], [], []]
                    for first in range(0, len(a.at), ANCHORS_AT):
                        part = slice(first, min(first + ANCHORS_AT, len(a.at)))
                        here = a.at[part]
                        lower, upper = intervals(a, part, bits, aligned, length)
                        alike = a.labels[part][:, None] == labels[None, :]
                        allowed = alike & (a.ids[part][:, None] != ids[None, :]) if same else ~alike
                        open_ = np.zeros_like(allowed)
                        for p in range(per_anchor):
                            open_ |= (upper >= floor[here, p][:, None]) & (lower <= high[here, p][:, None])
                        i, j = np.nonzero(allowed & open_)
                        if not len(i):
                            continue
                        size = float(a.length[part].max()) * float(length.max())
                        score = integer_scores(a.vectors[part], vectors, i, j, size)
                        for p in range(per_anchor):
                            fits = (score >= floor[here[i], p]) & (score <= high[here[i], p])
                            found[0].append(here[i[fits]] * per_anchor + p)
                            found[1].append(score[fits])
                            found[2].append(ids[j[fits]])
                    if not found[0]:
                        continue
                    merged = [np.concatenate([b, *f]) for b, f in zip(best, found)]
                    kept = best_of(*merged, keep)
                    best = [m[kept] for m in merged]
                    per = np.bincount(best[0], minlength=floor.size)
                    full = np.flatnonzero(per >= keep)
                    floor.reshape(-1)[full] = best[1][np.cumsum(per)[full] - 1]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, (_, t) in zip(best, fields)], [n for n, _ in fields])

    return map_arrow(rows.select("id", "label", "dim", "v", "bits", "aligned", "length"), run, "query bigint, score bigint, id bigint")


def _ranked(found: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def mine(vectors: DataFrame, anchor: Callable[[Column], Column], key: str = "vec_id", vector: str = "embedding", label: str = "label", positives: int = 5,
         negatives: int = 3, percent: tuple[int, int] = (50, 95), scale: int = 256, codes: int = CODES, planes: int = PLANES,
         block: int = BLOCK, task_rows: int = TASK_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): hard negatives of the rows whose key meets ``anchor``.

    A vector becomes the floor of ``scale`` times each component, and a score is the integer inner
    product with the anchor; higher ones come first, equal ones by smaller key. An anchor's
    positives are its first rows of the same label with another key; a positive's negatives are the first
    rows of other labels with percent[0] * positive <= 100 * negative <= percent[1] * positive.
    Rows with a NULL key, label or vector, an empty vector, or a component that is NULL or (scaled)
    not finite take no part. Rows that repeat key, label and vector count once; rows that share
    only the key are rows of their own. Vectors of different dimensions never meet. Keys and labels are
    integers; scores beyond 64 bits are held at their limits. No row or table without anchors gives no rows.
    """
    spark = vectors.sparkSession
    sc = spark.sparkContext
    rows = materialise(coded(vectors, key, vector, label, scale, codes))
    asked = materialise(rows.where(anchor(F.col("id"))).select("id", "label", "v"))
    n_rows, n_asked = rows.count(), asked.count()
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if not n_asked:
        return spark.createDataFrame([], schema)
    rows = rows.coalesce(max(sc.defaultParallelism, -(-n_rows // task_rows)))
    blocks = -(-n_asked // block)
    out = scratch_path(spark)
    for b in range(blocks):
        # The hash deals about ``block`` anchors to each block.
        chosen = asked.where(F.pmod(F.xxhash64("id", "label", "v"), F.lit(blocks)) == b).collect()
        ids = np.array([r.id for r in chosen], np.int64)
        labels = np.array([r.label for r in chosen], np.int64)
        vs = [np.frombuffer(bytes(r.v), np.float64) for r in chosen]
        anchors = {}
        for dim in {len(v) for v in vs}:
            at = np.array([i for i, v in enumerate(vs) if len(v) == dim])
            anchors[dim] = round_anchors(at, ids[at], labels[at], np.array([vs[i] for i in at]), codes, planes)
        any_score = (np.full((len(ids), 1), LARGEST.min), np.full((len(ids), 1), LARGEST.max))
        shared = sc.broadcast((anchors, *any_score))
        first = [(r["query"], r["rank"] - 1, r["id"], r["score"]) for r in _ranked(_best_rows(rows, shared, 1, positives, True), positives).collect()]
        shared.destroy()
        low, high = np.ones((len(ids), positives), np.int64), np.zeros((len(ids), positives), np.int64)
        pairs = []
        for at, p, positive, score in first:
            low[at, p], high[at, p] = -(-percent[0] * score // 100), percent[1] * score // 100
            pairs.append((at * positives + p, int(ids[at]), positive, score))
        shared = sc.broadcast((anchors, low, high))
        found = _ranked(_best_rows(rows, shared, positives, negatives, False), negatives)
        named = spark.createDataFrame(pa.table({n: pa.array([x[i] for x in pairs], pa.int64()) for i, n in enumerate(
            ("query", "anchor_id", "positive_id", "positive_score"))}))
        found.join(F.broadcast(named), "query").select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")).write.mode("append").parquet(out)
        shared.destroy()
    return spark.read.schema(schema).parquet(out)
