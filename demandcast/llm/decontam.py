"""Benchmark decontamination by MinHash containment search, in DataFrame functions only.

Test items are split by size, and an item's sketch is its smallest shingle hashes: so many that
a document with the required share of the item cannot miss all of them, or, for long items,
misses them with probability (1 - containment)^``SKETCH_MOST``. A document is a candidate for the
items whose sketch it hits; candidates are confirmed on all shingles of item and document.
Documents are read whole and never paired with each other or with items that they do not hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandcast.llm.common import drop_keys, hash_filter, keep_possible, size_bytes
from demandcast.session import materialise

WIDTH = 5
SKETCH_MOST = 24


def words(text: Column) -> Column:
    """Lower-cased runs without space and 0x09-0x0D; NULL counts as empty."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: F.length(w) > 0)


def shingle_hashes(tokens: Column, width: int = WIDTH) -> Column:
    """Hashes of every run of ``width`` words; of all words when there are fewer; none without words."""
    def runs(w: Column) -> Column:
        n = F.size(w)
        each = F.transform(F.sequence(F.lit(0), n - width), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(width)]))
        return F.when(n >= width, each).when(n > 0, F.array(F.xxhash64(F.array_join(w, " "), F.lit(width)))).otherwise(
            F.array().cast("array<bigint>"))

    # The one-element array binds the words once for all runs.
    return F.transform(F.array(tokens), runs)[0]


def item_table(items: DataFrame, text: str, key: str, containment: float, width: int) -> DataFrame:
    """(item_id, n_item, size_class, shingles, sketch) of items with words; of repeated ids all texts count as one row each."""
    hashes = items.where(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").alias("item_id"), words(F.col(f"`{text}`")).alias("w")).select(
        "item_id", F.array_sort(F.array_distinct(shingle_hashes(F.col("w"), width))).alias("shingles")).where(F.size("shingles") > 0).distinct()
    n = F.size("shingles")
    # With k of n shingles left out of a hit, at most n - k can be shared: k as below cannot all be missed.
    most = F.when(F.col("size_class") >= 7, F.least(n - F.ceil(n * containment - 1e-9) + 1, F.lit(SKETCH_MOST))).otherwise(
        n - F.ceil(n * containment - 1e-9) + 1)
    return hashes.withColumns({"n_item": n, "size_class": F.floor(F.log2(n.cast("double"))).cast("int")}).withColumn(
        "sketch", F.slice("shingles", 1, most.cast("int")))


def contained_items(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text",
                    item_key: str = "item_id", containment: float = 0.8, width: int = WIDTH) -> DataFrame:
    """(key, item_id, n_item, n_shared, containment) where a document holds that share of an item's shingles.

    Sets are of distinct ``width``-word shingles; an item or document of fewer words is one
    shingle of its own and matches only its like. NULL or empty texts hold nothing and are held
    by nothing; rows with a NULL key are not reported. Pairs are returned once, however often
    rows repeat. The sketch table is written first, so that the planner knows its size and
    decides on a broadcast; beyond the threshold it shuffles hits only.
    """
    table = materialise(item_table(items, item_text, item_key, containment, width))
    probes = materialise(table.select("item_id", F.explode("sketch").alias("h")).distinct())
    known = docs.where(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").alias("_id"), F.col(f"`{text}`").alias("_t"))
    hits = known.select("_id", shingle_hashes(words(F.col("_t")), width).alias("s")).select("_id", F.explode("s").alias("h"))
    hits = hits.join(probes, "h") if _small(probes) else keep_possible(hits, "h", hash_filter(probes, "h")).join(probes, "h")
    pairs = materialise(hits.select("_id", "item_id").distinct())

    wanted = keep_possible(known, "_id", hash_filter(pairs, "_id"))
    sets = wanted.select("_id", F.array_distinct(shingle_hashes(words(F.col("_t")), width)).alias("s"))
    both = F.size(F.array_intersect("s", "shingles"))
    found = pairs.join(sets, "_id").join(table.select("item_id", "n_item", "shingles"), "item_id").select(
        F.col("_id").alias(key), "item_id", "n_item", both.alias("n_shared"))
    best = found.groupBy(key, "item_id").agg(F.max(F.struct((F.col("n_shared") / F.col("n_item")).alias("c"), "n_item", "n_shared")).alias("m"))
    return best.select(key, "item_id", F.col("m.n_item").alias("n_item"), F.col("m.n_shared").alias("n_shared"),
                       F.col("m.c").alias("containment")).where(F.col("containment") >= containment - 1e-12)


def _small(df: DataFrame) -> bool:
    """Whether the planner would broadcast the table of its own accord."""
    return 0 <= size_bytes(df) <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """Documents that hold no test item, with all their columns; rows with a NULL key stay."""
    return drop_keys(docs, key, contained_items(docs, items, text, key, **options).select(key))
