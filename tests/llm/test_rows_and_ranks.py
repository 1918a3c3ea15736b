"""Lexical search, shards and hard negatives against brute force: NULLs, ties, repeats, long texts, clashing names, hot groups."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandcast.llm import hardneg, lexsearch, sharding

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, ids=None):
    """Documents of texts, with columns whose names the operators use inside."""
    rows = [(i if ids is None else ids[i], t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).withColumns(
        {n: F.lit("x") for n in ("key", "size", "part", "shard", "term", "item", "score", "doc", "k", "t", "item_id", "at")})


# --- 11: ranked lexical search --------------------------------------------------------------

def fold(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", fold(text))


def search_by_hand(docs, items, keep):
    """docs: (id, text); items: {id: set of terms}."""
    bags = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, length = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = set()
    for item, wanted in items.items():
        found = []
        for d, b in bags:
            m = 50 + 50 * sum(b.values()) * n_docs // max(length, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * b[t] // (1000 * b[t] + 20 * m)) for t in wanted if b[t])
            if s > 0:
                found.append((-s, d is None, d or 0, d))
        out |= {(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(found)[:keep])}
    return out


def corpus():
    rng = random.Random(3)
    vocabulary = ["a", "ab", "abc", "b", "É", "é", "straße", "語", "\xa0nb", "\x85x", "x1", "42", "zz"] + [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 30))) for _ in range(150)]
    texts += [None, "", " ,.", "A-B_c'AB", "ab,ab;AB", "same text zz"] + ["same text zz"] * 90
    return texts + ["Ab " * 200_000 + "rare", "x" * 1_000_000]


ITEMS = [(1, "AB abc, rare!"), (2, None), (3, ""), (4, "no such thing at all w1"), (5, "straße É 語"), (5, "w2"), (None, "zz w3"), (7, "zz"), (8, "\x85x \xa0nb"), (7, "zz")]


def test_search_equals_brute_force(spark, monkeypatch):
    texts = corpus()
    ids = [None if i in (3, 4) else i - 20 for i in range(len(texts))]
    ids[-1] = ids[-2]
    wanted = {}
    for i, t in ITEMS:
        wanted.setdefault(i, set()).update(terms(t))
    want = search_by_hand(list(zip(ids, texts)), wanted, 7)
    docs, items = frame(spark, texts, ids).repartition(5), spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("doc_id", F.lit("x"))
    got = lexsearch.search(docs, items, keep=7)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)
    monkeypatch.setattr(lexsearch, "BATCH", 9)
    small = lexsearch.search(docs, items, keep=7, most_items=2, most_terms=3)
    assert {tuple(r) for r in small.collect()} == want


def test_search_of_empty_tables(spark):
    docs, items = frame(spark, ["a b", "b"]), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexsearch.search(docs.limit(0), items).count() == 0
    assert lexsearch.search(docs, items.limit(0)).count() == 0
    assert lexsearch.search(frame(spark, [None, "--"]), items).count() == 0


# --- 12: shards -------------------------------------------------------------------------------

def by_hand(texts, shards):
    """Bytes before each record in the order of (digest, id) decide."""
    import hashlib

    rows = sorted((hashlib.md5((t or "").encode()).hexdigest()[:15], i, len((t or "").encode()) + 1) for i, t in enumerate(texts))
    total, done, slots, out = sum(r[2] for r in rows), 0, Counter(), {}
    for _, i, size in rows:
        done += size
        shard = min(shards - 1, (2 * done - size) * shards // (2 * total))
        out[i] = (size, zlib.crc32((texts[i] or "").encode()), "bytes", shard, slots[shard], None)
        slots[shard] += 1
    return out


@pytest.mark.parametrize("sizes", [{}, {"fanout": 4, "per_range": 3, "range_rows": 9}])
def test_shards_equal_brute_force(spark, sizes):
    """A third of the rows holds one text; ranges of nine rows cut it many times."""
    rng = random.Random(8)
    texts = [None, "", "é語", "z" * 300_000] + ["hot"] * 150 + ["".join(rng.choice("abc d") for _ in range(rng.randint(0, 400))) for _ in range(300)]
    got = {r.doc_id: tuple(r)[1:] for r in sharding.assign(frame(spark, texts).repartition(7), 5, **sizes).collect()}
    assert got == by_hand(texts, 5)


def test_shards_of_repeated_and_keyless_rows(spark):
    docs = frame(spark, ["same"] * 40 + ["b"], [1] * 30 + [None] * 10 + [2])
    got = sharding.assign(docs, 4, fanout=2, per_range=2, range_rows=5).collect()
    assert Counter(r.doc_id for r in got) == {1: 30, None: 10, 2: 1}
    for s in range(4):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    bytes_ = Counter()
    for r in got:
        bytes_[r.shard] += r.size
    assert max(bytes_.values()) - min(bytes_.values()) <= 5
    assert sharding.assign(docs.limit(0)).count() == 0


def test_samples_are_bounded_and_ranges_small(spark):
    docs = frame(spark, ["hot"] * 3000 + [f"t{i}" for i in range(3000)])
    rows = sharding.ranged(sharding._records(docs, "doc_id", "text"), fanout=8, per_range=8, range_rows=500)
    sizes = [r["count"] for r in rows.groupBy("part").count().collect()]
    assert max(sizes) <= 500 and sum(sizes) == 6000 and len(sizes) >= 12
    first = sharding._splitters(sharding._records(docs, "doc_id", "text"), spark.createDataFrame([(0, 6000, 6000 * 5)], "part long, rows long, bytes long"), 8, 8, 0)
    assert len(first.first().cuts) <= 7


def test_written_shards_hold_all_rows_in_slot_order(spark, tmp_path):
    docs = frame(spark, [f"text {i}" * (i % 9) for i in range(200)])
    placed = sharding.write_shards(docs, str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.select(*docs.columns).exceptAll(docs).count() == 0 and back.count() == 200
    both = back.join(placed.select(F.col("doc_id").alias("d"), F.col("shard").alias("s"), "slot"), F.col("d") == F.col("doc_id"))
    assert both.where("s <> _in OR slot <> _at").count() == 0
    with pytest.raises(ValueError):
        sharding.write_shards(docs.unionByName(docs), str(tmp_path / "twice"), 3)


# --- 13: hard negatives -----------------------------------------------------------------------

def mine_by_hand(rows, percent=(50, 95)):
    rows = [(i, lab, [math.floor(256 * x) for x in v]) for i, v, lab in rows
            if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    rows = [r for n, r in enumerate(rows) if r not in rows[:n]]
    out = []
    for i, lab, v in rows:
        if i % 5:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in rows if len(w) == len(v)]
        for p, j, _ in sorted(s for s in scored if s[2] == lab and s[1] != i)[:5]:
            fit = sorted((s, k) for s, k, other in scored if other != lab and 50 * -p <= 100 * -s <= 95 * -p)
            out += [(i, j, r + 1, k, -p, -s) for r, (s, k) in enumerate(fit[:3])]
    return sorted(out)


SCHEMA = "vec_id long, embedding array<double>, label int"


def vectors(seed, n, dim):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((4, dim))
    return [(i, (centres[i % 4] * rng.uniform(0, 1.5) + rng.standard_normal(dim)).tolist(), int(rng.integers(0, 3))) for i in range(n)]


@pytest.mark.parametrize("sizes", [{}, {"block": 4, "task_rows": 40, "codes": 2, "planes": 4}])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, sizes):
    monkeypatch.setattr(hardneg, "ROWS_AT", 50)
    monkeypatch.setattr(hardneg, "ANCHORS_AT", 3)
    rows = vectors(1, 120, 20) + [(200 + i, v, lab) for i, v, lab in vectors(2, 40, 70)]
    rows += [(i, rows[7][1], i % 3) for i in range(300, 360)]  # one vector many times: ties
    rows += [rows[10], rows[10], (10, rows[11][1], 1), (None, rows[1][1], 1), (400, None, 1), (405, [], 1), (410, [1.0, None], 1), (415, [1.0, math.nan], 1),
             (420, [math.inf, 1.0], 1), (425, rows[0][1], None), (430, [0.0] * 20, 0), (435, [0.0] * 20, 1), (440, [0.0] * 20, 0), (-5, rows[3][1], 2)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("x") for n in ("id", "v", "bits", "query", "score", "dim")})
    got = hardneg.mine(df.repartition(5), lambda key: key % 5 == 0, **sizes)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == mine_by_hand(rows) and got.count() > 100


def test_hard_negatives_of_large_numbers_and_nothing(spark):
    rows = [(i, [1e9 * (i + 1), 3.7e8 * i, 1.0, -2.5], i % 2) for i in range(12)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, hardneg.mine(df, lambda key: key % 5 == 0).collect()))
    clipped = [r for r in mine_by_hand(rows) if r[4] < 2 ** 63 and r[5] < 2 ** 63]
    assert [r for r in got if r[4] < 2 ** 63 - 1 and r[5] < 2 ** 63 - 1] == clipped
    assert hardneg.mine(df.limit(0), lambda key: key % 5 == 0).count() == 0
    assert hardneg.mine(df, lambda key: key == 999).count() == 0


def test_intervals_hold_every_score():
    """The width is a bound, whatever the vectors: sparse, equal, opposite, zero."""
    rng = np.random.default_rng(5)
    for dim in (3, 64, 100):
        v = np.floor(256 * rng.standard_normal((300, dim)) * (rng.random((300, dim)) < rng.random((300, 1))))
        v[0], v[1], v[2], v[3:9] = 0, v[5], -v[5], 0
        v[3:9, 0] = [1, -1, 1000, 5, 7, 1 << 20]
        bits, aligned, length = hardneg.encode(v, 4)
        a = hardneg.round_anchors(np.arange(300), np.arange(300), np.zeros(300), v, 4, 6)
        low, high = hardneg.intervals(a, slice(0, 300), bits, aligned, length)
        exact = v @ v.T
        assert (low <= exact).all() and (exact <= high).all()
        size = length[:, None] * length[None, :]
        assert np.median(((high - low) / 2)[size > 0] / size[size > 0]) < 0.2
