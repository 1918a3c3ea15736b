"""MinHash near-duplicates by an LSH forest with adaptive depth and exact confirmation.

Several orders of the signature (rotations) act as prefix trees. Documents that share a
prefix are candidates; a region with more than ``REGION`` documents is refined to longer
prefixes in more orders, and its documents are also compared with the region's centre, the
document closest to the column-wise mode of the signatures. So a large group of near copies
costs a number of candidates linear in its size. What these leave in different components of
a large region is compared pair by pair in cells of bounded size. Copies of one shingle set are one candidate.
Links are confirmed on full shingle sets; a candidate whose ends are already connected needs
no confirmation, because it cannot change a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.llm.common import connected_components, cross_cells, hash_filter, joining, keep_possible, map_arrow
from demandcast.llm.shingles import SKETCH, digest_of, sets_of, sketch_of, text_groups
from demandcast.session import materialise

#: Signature values that two documents must share in one of the orders, to start with.
DEPTH = 3
#: Orders of the signature at that depth: a pair at 0.85 is missed with probability 7e-5.
TREES = 10
#: Documents of a region that are compared with each other; larger regions are refined.
REGION = 128
#: Depths and orders inside refined regions.
DEEPER, DEEP_TREES = (6, 12, 24, 48), 32
#: Where each order starts: the first orders, then those of refined regions.
STARTS = [SKETCH // TREES * t for t in range(TREES)] + [SKETCH // DEEP_TREES * t for t in range(DEEP_TREES)]
#: Weight of a block of documents, each its shingles and ``DOC_WEIGHT``; two blocks are held at a time.
BLOCK, DOC_WEIGHT = 1 << 18, 128
#: Shingles of a cell that are matched at a time.
COLUMNS = 4096
#: Marks an order in which a document is in no small region.
NEVER = 255
#: Documents that one task reads at a time when it looks for a region's mode.
MODE_ROWS = 2048


def signatures(docs: DataFrame, text: str, key: str, width: int) -> DataFrame:
    """(key, n_shingles, digest, sig): set size, digest of the set and MinHash sketch of whole texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in text_groups(batch.column(1)):
                sets = sets_of(texts, width)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(sets)), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([digest_of(s) for s in sets], pa.binary()),
                     pa.array([sketch_of(s).tobytes() for s in sets], pa.binary())], ["id", "n_shingles", "digest", "sig"])

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("t"))
    return map_arrow(rows, run, "id bigint, n_shingles bigint, digest binary, sig binary")


def full_sets(docs: DataFrame, text: str, key: str, width: int) -> DataFrame:
    """(id, items): the sorted shingle hashes of whole texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in text_groups(batch.column(1)):
                sets = sets_of(texts, width)
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                values = np.concatenate(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(sets)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], ["id", "items"])

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("t"))
    return map_arrow(rows, run, "id bigint, items array<bigint>")


# --- forest -------------------------------------------------------------------------------

def _prefix(tree, depth: int, trees: int):
    """Hash of a tree's first values: the order of tree t starts at position t * SKETCH / trees."""
    start = (tree * F.lit(SKETCH // trees)).cast("int")
    turned = F.concat(F.substr("sig", start * 4 + 1), F.substr("sig", F.lit(1), start * 4))
    return F.xxhash64(tree, F.lit(depth), F.substr(turned, F.lit(1), F.lit(4 * depth)))


def _keys(rows: DataFrame, depth: int, trees: int) -> DataFrame:
    """(id, tree, region) for each order of each signature."""
    return rows.select("id", "sig", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")).select(
        "id", "tree", _prefix(F.col("tree"), depth, trees).alias("region"))


def _sized(keys: DataFrame) -> DataFrame:
    """Keys of regions with several documents, and how many; sizes are counted map-side."""
    sizes = keys.groupBy("region").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return keys.join(sizes, "region")


def _matches(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, None, :] == b[None, :, :]).sum(axis=2, dtype=np.int16)


def _spanning(equal: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Edges of a maximum spanning forest over pairs with at least ``least`` equal values (Prim)."""
    n, out = len(equal), []
    left = np.ones(n, bool)
    best, link = np.full(n, -1, np.int32), np.full(n, -1, np.int64)
    for _ in range(n):
        at = int(np.where(left, best, -2).argmax())
        left[at] = False
        if best[at] >= least:
            out.append((int(link[at]), at))
        better = left & (equal[at] > best)
        best[better], link[better] = equal[at][better], at
    return out


def _shared_before(equal: np.ndarray, order: np.ndarray, depths: np.ndarray) -> np.ndarray:
    """Whether pairs share a region of an earlier order too, from their equal signature positions.

    ``equal`` (pairs, SKETCH), ``order`` (pairs,) the order at hand, ``depths`` (pairs, orders) the depth
    at which the first document's region is small enough in each order, or ``NEVER``.
    """
    runs = np.zeros((len(equal), 2 * SKETCH + 1), np.int16)
    np.cumsum(np.concatenate([equal, equal], axis=1), axis=1, out=runs[:, 1:])
    found = np.zeros(len(equal), bool)
    for o, start in enumerate(STARTS):
        depth = np.minimum(depths[:, o], SKETCH)
        at = np.take_along_axis(runs, (start + depth)[:, None], axis=1)[:, 0] - runs[:, start]
        found |= (o < order) & (depths[:, o] != NEVER) & (at == depth)
    return found


def _region_pairs(rows: DataFrame, least: int, crossing: bool) -> DataFrame:
    """(a, b) of likely pairs inside small regions, from (region, id, sig[, component, place, depths]).

    Either the spanning forest of each region's likely pairs, or all its likely pairs between
    different components, each in the first order that brings the two together. A region has at
    most ``REGION`` documents and is seen by one task, which streams over its regions.
    """
    names = ["region", "id", "sig"] + (["component", "place", "depths"] if crossing else [])

    def of(rows_: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array([r[1] for r in rows_], np.int64)
        sig = np.frombuffer(b"".join(r[2] for r in rows_), ">u4").reshape(len(rows_), -1).astype(np.uint32)
        equal = _matches(sig, sig)
        if crossing:
            comp = np.array([r[3] for r in rows_], np.int64)
            i, j = np.nonzero(np.triu((equal >= least) & (comp[:, None] != comp[None]), 1))
            if len(i):
                place, depths = np.array([r[4] for r in rows_]), np.array([r[5] for r in rows_], np.int64)
                new = ~_shared_before(sig[i] == sig[j], place[i], depths[i])
                i, j = i[new], j[new]
        else:
            edges = _spanning(equal, least)
            i, j = (np.array([e[x] for e in edges], np.int64) for x in (0, 1))
        return np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region, members, out, held = None, [], [], 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if row[0] != region:
                    if len(members) > 1:
                        out.append(of(members))
                        held += len(out[-1][0])
                    region, members = row[0], []
                members.append(row)
            if held > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["a", "b"])
                out, held = [], 0
        if len(members) > 1:
            out.append(of(members))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["a", "b"])

    grouped = rows.select(*names).repartition("region").sortWithinPartitions("region")
    return map_arrow(grouped, run, "a bigint, b bigint").where("a <> b").distinct()


def _centres(rows: DataFrame) -> DataFrame:
    """(region, centre, centre_sig) of large regions, from (region, id, sig).

    The mode of every signature position is counted in two steps: tasks count runs of rows they
    happen to hold, sums of these counts are grouped per region. Nothing gathers a region.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, MODE_ROWS):
                part = batch.slice(at, MODE_ROWS)
                region = part.column(0).to_numpy()
                sig = np.frombuffer(b"".join(part.column(1).to_pylist()), ">u4").reshape(len(region), -1).astype(np.int64)
                out = []
                order = np.argsort(region, kind="stable")
                for rows_ in np.split(order, np.flatnonzero(np.diff(region[order])) + 1):
                    for pos in range(SKETCH):
                        values, n = np.unique(sig[rows_, pos], return_counts=True)
                        # A value seen once in a run of many rows is not worth its row unless all are.
                        keep = np.argsort(-n, kind="stable")[:4]
                        out += [(region[rows_[0]], pos, values[k], n[k]) for k in keep]
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                     pa.array(cols[3], pa.int64())], ["region", "pos", "value", "n"])

    votes = map_arrow(rows.select("region", "sig"), count, "region bigint, pos int, value bigint, n bigint")
    mode = votes.groupBy("region", "pos", "value").agg(F.sum("n").alias("n")).groupBy("region", "pos").agg(
        F.max(F.struct("n", "value")).alias("m")).groupBy("region").agg(
        F.array_sort(F.collect_list(F.struct("pos", F.col("m.value").alias("value")))).alias("mode"))
    wanted = mode.select("region", F.transform("mode", lambda x: x["value"]).alias("mode"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column(2).to_pylist()), ">u4").reshape(batch.num_rows, -1).astype(np.int64)
            mode_ = np.array(batch.column(3).to_pylist(), np.int64).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array((sig == mode_).sum(axis=1).astype(np.int64))],
                                             ["region", "id", "sig", "equal"])

    scored = map_arrow(rows.join(wanted, "region").select("region", "id", "sig", "mode"), score,
                       "region bigint, id bigint, sig binary, equal bigint")
    return scored.groupBy("region").agg(F.max(F.struct("equal", (-F.col("id")).alias("minus"), "sig")).alias("m")).select(
        "region", (-F.col("m.minus")).alias("centre"), F.col("m.sig").alias("centre_sig"))


def _centre_pairs(rows: DataFrame, least: int) -> DataFrame:
    """(a, b): documents of large regions with their region's centre, where likely."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (np.frombuffer(b"".join(batch.column(i).to_pylist()), ">u4").reshape(batch.num_rows, -1) for i in (1, 3))
            fine = np.flatnonzero((one == two).sum(axis=1) >= least)
            ids, centres = batch.column(0).to_numpy()[fine], batch.column(2).to_numpy()[fine]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ids, centres)), pa.array(np.maximum(ids, centres))], ["a", "b"])

    joined = rows.join(_centres(rows), "region").where("id <> centre").select("id", "sig", "centre", "centre_sig")
    return map_arrow(joined, run, "a bigint, b bigint").distinct()


def _confirmed(pairs: DataFrame, docs: DataFrame, text: str, key: str, width: int, percent: int) -> DataFrame:
    """Pairs whose full sets have ``percent`` or more of their union in common.

    A fixed-size filter of the wanted ids is applied to the scan, so sets are made and moved
    for about the documents in question only.
    """
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    wanted = keep_possible(docs.select(key, text).where(F.col(f"`{key}`").isNotNull()).withColumnRenamed(key, "_id"),
                           "_id", hash_filter(ids, "id"))
    sets = full_sets(wanted, text, "_id", width)
    one, two = sets.select(F.col("id").alias("a"), F.col("items").alias("x")), sets.select(F.col("id").alias("b"), F.col("items").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", both.alias("i"), (F.size("x") + F.size("y") - both).alias("u")).where(
        f"100 * i >= {percent} * u AND u > 0").select("a", "b")


def _wanted_sets(ids: DataFrame, docs: DataFrame, text: str, key: str, width: int) -> DataFrame:
    """(id, items): sets of the documents that may be among ``ids``, each key once."""
    wanted = keep_possible(docs.select(key, text).where(F.col(f"`{key}`").isNotNull()).withColumnRenamed(key, "_id"),
                           "_id", hash_filter(ids, "id"))
    return full_sets(wanted, text, "_id", width)


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, one of each side."""
    x, y = (np.repeat(np.arange(len(v)), [len(z) for z in v]) for v in (left, right))
    g, h = np.concatenate(left), np.concatenate(right)
    known = np.intersect1d(g, h)
    mine, theirs = np.isin(g, known), np.isin(h, known)
    x, g, y, h = x[mine], np.searchsorted(known, g[mine]), y[theirs], np.searchsorted(known, h[theirs])
    out = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(known), COLUMNS):
        one, two = (g >= at) & (g < at + COLUMNS), (h >= at) & (h < at + COLUMNS)
        a, b = np.zeros((len(left), COLUMNS), np.float32), np.zeros((len(right), COLUMNS), np.float32)
        a[x[one], g[one] - at] = 1
        b[y[two], h[two] - at] = 1
        out += a @ b.T
    return out.astype(np.int64)


def _links_across(members: DataFrame, docs: DataFrame, text: str, key: str, width: int, percent: int) -> DataFrame:
    """(a, b): links between members of a region in different components, as many as join them.

    ``members`` has (k, id, c, w). Every such pair is compared on its full sets; of several
    links of a cell that join the same components one is returned.
    """
    cells = cross_cells(members, BLOCK)

    def of(rows: list[tuple]) -> tuple[list[int], list[int]]:
        i, j = rows[0][1:3]
        one = [r for r in rows if r[3] == i]
        two = one if i == j else [r for r in rows if r[3] == j]
        if not one or not two:
            return [], []
        both = _common([r[6] for r in one], [r[6] for r in two])
        either = np.array([len(r[6]) for r in one])[:, None] + np.array([len(r[6]) for r in two])[None] - both
        x, y = np.nonzero(100 * both >= percent * either)
        p, q = np.array([r[5] for r in one], np.int64)[x], np.array([r[5] for r in two], np.int64)[y]
        x, y, p, q = (v[p != q] for v in (x, y, p, q))
        fine = joining(p.tolist(), q.tolist())
        return [one[v][4] for v in x[fine]], [two[v][4] for v in y[fine]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            items = batch.column(6)
            for n, row in enumerate(zip(*[batch.column(c).to_pylist() for c in range(6)])):
                if row[:3] != at:
                    if held:
                        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in of(held)], ["a", "b"])
                    at, held = row[:3], []
                held.append((*row, items[n].values.to_numpy()))
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in of(held)], ["a", "b"])

    sets = _wanted_sets(cells.select("id").distinct(), docs, text, key, width).dropDuplicates(["id"])
    rows = cells.join(sets, "id").select("k", "i", "j", "side", "id", "c", "items")
    return map_arrow(rows.repartition("k", "i", "j").sortWithinPartitions("k", "i", "j"), run, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = 5, percent: int = 85) -> DataFrame:
    """(key, n_shingles, component_id, kept): the components of near-duplicate documents.

    Documents are linked when 100 * intersection >= percent * union of their shingle sets.
    ``component_id`` is the smallest key reachable over links, itself included; ``kept`` marks
    it. Texts without words (or NULL) have an empty set and link with nothing; a row with a
    NULL key links with nothing, has a NULL component and is kept. Rows that repeat a key are
    each returned and share a component. Keys are integers.
    """
    rows = materialise(signatures(docs, text, key, width))
    some = rows.where("n_shingles > 0 AND id IS NOT NULL")
    leaders = some.groupBy("digest").agg(F.min("id").alias("leader"))
    heads = materialise(some.join(leaders.select(F.col("leader").alias("id")).distinct(), "id", "left_semi").select("id", "sig").dropDuplicates(["id"]))

    # A likely pair may fall 4.2 standard deviations short of the threshold in the sketch.
    share = percent / 100
    least = int(np.floor(SKETCH * share - 4.2 * np.sqrt(SKETCH * share * (1 - share))))

    sized = materialise(_sized(_keys(heads, DEPTH, TREES)))
    big = sized.where(f"size > {REGION}").select("id", "region")
    small = [sized.where(f"size <= {REGION}").select("region", "id", F.col("tree").alias("place"), F.lit(DEPTH).alias("depth"))]
    candidates = []
    if not big.isEmpty():
        candidates.append(_centre_pairs(materialise(big.join(heads, "id")), least))
        left = heads.join(big.select("id").distinct(), "id", "left_semi").select(
            "id", "sig", F.explode(F.sequence(F.lit(0), F.lit(DEEP_TREES - 1))).alias("tree"))
        for depth in DEEPER:
            level = materialise(_sized(left.select("id", "tree", "sig", _prefix(F.col("tree"), depth, DEEP_TREES).alias("region"))))
            small.append(level.where(f"size <= {REGION}").select(
                "region", "id", (F.col("tree") + TREES).alias("place"), F.lit(depth).alias("depth")))
            left = level.where(f"size > {REGION}")
            if left.isEmpty():
                break
            if depth == DEEPER[-1]:
                candidates.append(_centre_pairs(materialise(left.select("region", "id", "sig")), least))
            left = left.select("id", "sig", "tree")
    regions = small[0]
    for more in small[1:]:
        regions = regions.unionByName(more)
    # A document is in one region per order at most, so its list of depths is short.
    depths = regions.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("place", "depth"))).alias("m")).select(
        "id", F.transform(F.sequence(F.lit(0), F.lit(len(STARTS) - 1)), lambda o: F.coalesce(F.element_at("m", o), F.lit(NEVER))).alias("depths"))
    regions = materialise(regions.join(heads, "id").select("region", "id", "sig", "place"))
    candidates.append(_region_pairs(regions, least, crossing=False))
    pairs = candidates[0]
    for more in candidates[1:]:
        pairs = pairs.unionByName(more)
    pairs = materialise(pairs.distinct())
    links = materialise(_confirmed(pairs, docs, text, key, width, percent))
    groups = materialise(connected_components(links.select(F.col("a").alias("src"), F.col("b").alias("dst"))))

    # Pairs that the spanning forests left out matter only between components.
    placed = regions.join(groups.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    # Regions whose documents are all connected have nothing left to find.
    apart = placed.groupBy("region").agg((F.min("component") < F.max("component")).alias("apart")).where("apart").select("region")
    placed = placed.join(apart, "region").join(depths, "id")
    more = _region_pairs(placed, least, crossing=True).join(pairs, ["a", "b"], "left_anti")
    late = materialise(_confirmed(materialise(more), docs, text, key, width, percent))
    if not late.isEmpty():
        links = links.unionByName(late)
        groups = materialise(connected_components(links.select(F.col("a").alias("src"), F.col("b").alias("dst"))))
    if not big.isEmpty():
        # Pairs of large regions that refining has parted.
        crowd = big.join(groups.withColumnRenamed("node", "id"), "id", "left").join(
            some.groupBy("id").agg(F.max("n_shingles").alias("n_shingles")), "id").select(
            F.col("region").alias("k"), "id", F.coalesce("component", "id").alias("c"), (F.col("n_shingles") + DOC_WEIGHT).alias("w"))
        across = materialise(_links_across(crowd, docs, text, key, width, percent))
        if not across.isEmpty():
            groups = connected_components(links.unionByName(across).select(F.col("a").alias("src"), F.col("b").alias("dst")))

    placed = rows.join(leaders, "digest", "left").join(groups.withColumnRenamed("node", "leader"), "leader", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "leader", "id")).otherwise(F.col("id"))
    return placed.select(F.col("id").alias(key), "n_shingles", F.when(F.col("id").isNotNull(), component).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))
