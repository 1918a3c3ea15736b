"""Ranked lexical search without an index: one automaton of all item terms runs over every text.

Items come in blocks of bounded size. The terms of a block, each between two guards, form an
Aho-Corasick automaton that every task builds from a broadcast list. One scan of the documents
counts how many hold each term, a second one counts the terms again, maps the automaton's
outputs to items and keeps the best documents of its task. No posting list is written.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandcast.llm.common import map_arrow
from demandcast.session import materialise, scratch_path

#: Terms are runs of characters that are none of these: ASCII but letters and digits.
NO_TERM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (item, term) pairs whose terms one automaton holds: its size and that of the broadcast list follow from it.
BLOCK_TERMS = 200_000
#: Items whose scores a task holds for a batch of documents.
BLOCK_ITEMS = 2_000
#: Documents a task scores at a time.
BATCH = 500
GUARD = " "
#: One byte each: letters in lower case, digits and bytes of longer characters as they are, all else a guard.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: Column) -> Column:
    """All terms of a text in order; NULL and texts without any have none."""
    return F.filter(F.split(F.translate(text, UPPER, LOWER), NO_TERM), lambda t: t != "")


def folded(batch: pa.Array) -> Iterator[bytes]:
    """Texts as bytes in which guards stand around and between terms."""
    for raw in batch.cast(pa.large_binary()):
        yield b" %b " % (raw.as_py() or b"").translate(FOLD)


@lru_cache(maxsize=1)
def automaton(terms: tuple[str, ...]):
    """Guarded terms, in the bytes of UTF-8 one character each; outputs are their positions."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for i, t in enumerate(terms):
        found.add_word(GUARD + t.encode().decode("latin-1") + GUARD, i)
    found.make_automaton()
    return found


def counts(search, text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Terms of the automaton in a folded text and how often each occurs."""
    return np.unique(np.fromiter((i for _, i in search.iter(text.decode("latin-1"))), np.int64), return_counts=True)


def frequencies(docs: DataFrame, text: str, terms) -> DataFrame:
    """(term, n): documents that hold each term; in the rows -1 and -2 documents with any term, and all terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = terms.value
        held, some, length = np.zeros(len(words), np.int64), 0, 0
        search = automaton(words) if words else None
        for batch in batches:
            for t in folded(batch.column(0)):
                n = len(t.split())
                some, length = some + (n > 0), length + n
                if n and search:
                    held[counts(search, t)[0]] += 1
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array([*at.tolist(), -1, -2], pa.int64()), pa.array([*held[at].tolist(), some, length], pa.int64())],
                                         ["term", "n"])

    return map_arrow(docs.select(docs[f"`{text}`"].cast("string").alias("t")), run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


def best_of(item: np.ndarray, score: np.ndarray, doc: np.ndarray, keep: int) -> np.ndarray:
    """Positions of the ``keep`` highest scores of each item, equal ones by ascending document."""
    order = np.lexsort((doc, -score, item))
    group = item[order]
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, np.int64)
    rank = np.arange(len(group)) - np.repeat(first, np.diff(np.r_[first, len(group)]))
    return order[rank < keep]


def scored(docs: DataFrame, key: str, text: str, shared, keep: int) -> DataFrame:
    """(item, doc, null, score): the best ``keep`` documents of each item, task by task."""
    fields = [("item", pa.int32()), ("doc", pa.int64()), ("score", pa.int64())]
    none = np.iinfo(np.int64).max

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, weights, starts, owners, items, n_docs, length = shared.value
        search = automaton(words)
        best = [np.zeros(0, np.int64)] * 3
        floor = np.ones(items, np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                keys = batch.column(0).fill_null(none).to_numpy(zero_copy_only=False)
                total = np.zeros((batch.num_rows, items), np.int64)
                for row, t in enumerate(folded(batch.column(1))):
                    term, tf = counts(search, t)
                    if not len(term):
                        continue
                    m = 50 + 50 * len(t.split()) * n_docs // length
                    value = weights[term] * (1_000_000_000 * tf // (1_000 * tf + 20 * m))
                    size = starts[term + 1] - starts[term]
                    # Every item that holds a term, the term's items one after the other.
                    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(starts[term], size)
                    np.add.at(total[row], owners[place], np.repeat(value, size))
                row, item = np.nonzero(total >= floor)
                score = total[row, item]
                merged = [np.r_[a, b] for a, b in zip(best, (item, score, keys[row]))]
                kept = best_of(*merged, keep)
                best = [a[kept] for a in merged]
                # An item with enough documents asks for as much as its last one has.
                per = np.bincount(best[0], minlength=items)
                last = np.cumsum(per) - 1
                full = per >= keep
                floor[full] = best[1][last[full]]
        yield pa.RecordBatch.from_arrays([pa.array(best[0], pa.int32()), pa.array(best[2], pa.int64(), mask=best[2] == none), pa.array(best[1], pa.int64())],
                                         [n for n, _ in fields])

    source = docs.select(docs[f"`{key}`"].cast("long").alias("k"), docs[f"`{text}`"].cast("string").alias("t"))
    return map_arrow(source, run, "item int, doc bigint, score bigint")


def _blocks(items: DataFrame, key: str, text: str, most_items: int, most_terms: int) -> Iterator[list[tuple]]:
    """Items with their distinct terms, streamed to the driver in blocks of bounded size."""
    one = items.select(items[f"`{key}`"].cast("long").alias("item"), F.array_distinct(terms_of(items[f"`{text}`"].cast("string"))).alias("terms"))
    whole = one.groupBy("item").agg(F.array_distinct(F.flatten(F.collect_list(F.coalesce("terms", F.array().cast("array<string>"))))).alias("terms"))
    block, size = [], 0
    for row in materialise(whole.where("size(terms) > 0")).toLocalIterator():
        if block and (len(block) >= most_items or size + len(row.terms) > most_terms):
            yield block
            block, size = [], 0
        block.append((row.item, row.terms))
        size += len(row.terms)
    if block:
        yield block


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def search(docs: DataFrame, items: DataFrame, keep: int = 50, key: str = "doc_id", text: str = "text", item: str = "item_id",
           item_text: str = "text", most_items: int = BLOCK_ITEMS, most_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item, rank, key, score): for each item the ``keep`` documents of the highest scores above 0.

    Terms are maximal runs of ASCII letters, digits and other characters beyond ASCII; only A-Z is
    lower-cased. With N documents that have a term, L terms in all of them and n in one, m is
    50 + (50*n*N) div L, and a term of weight w = floor(1000*ln((2N+2)/(2df+1))) that occurs tf
    times adds w*((10^9*tf) div (1000*tf+20*m)) to the score of each item that holds it. Equal
    scores are ranked by ascending key, NULL keys last. Every row of ``docs`` is a document,
    repeated rows too; NULL and empty texts have no terms. Items that share an id, or have none, are one item
    with the terms of all; items without terms find nothing. Keys and ids are integers; empty
    tables give no rows. A text of any length is scanned whole; a task holds the best ``keep`` documents of the
    ``most_items`` items of one block and the scores of 500 documents.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    out = scratch_path(spark)
    name = {"item": item, "doc": key}
    schema = f"`{item}` bigint, rank int, `{key}` bigint, score bigint"
    found = 0
    for block in _blocks(items, item, item_text, most_items, most_terms):
        words = tuple(sorted({t for _, terms in block for t in terms}))
        place = {t: i for i, t in enumerate(words)}
        pairs = np.array(sorted((place[t], i) for i, (_, terms) in enumerate(block) for t in terms), np.int64)
        starts = np.searchsorted(pairs[:, 0], np.arange(len(words) + 1))
        listed = sc.broadcast(words)
        seen = {r.term: r.n for r in frequencies(docs, text, listed).collect()}
        listed.destroy()
        n_docs, length = seen.get(-1) or 0, seen.get(-2) or 0
        if not n_docs:
            break
        weights = np.array([weight(n_docs, seen.get(i, 0)) for i in range(len(words))], np.int64)
        shared = sc.broadcast((words, weights, starts, pairs[:, 1], len(block), n_docs, length))
        local = scored(docs, key, text, shared, keep)
        order = [F.col("score").desc(), F.col("doc").asc_nulls_last()]
        # First among the tasks of a slice of the documents, so that no task reads the rows of all tasks for an item.
        sliced = local.withColumn("slice", F.pmod(F.xxhash64("doc"), F.lit(32))).withColumn(
            "r", F.row_number().over(Window.partitionBy("item", "slice").orderBy(*order))).where(F.col("r") <= keep)
        ids = F.array(*[F.lit(i).cast("long") for i, _ in block])
        ranked = sliced.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= keep)
        ranked.select(F.element_at(ids, F.col("item") + 1).alias(name["item"]), "rank", F.col("doc").alias(name["doc"]), "score").write.mode("append").parquet(out)
        shared.destroy()
        found += 1
    return spark.read.schema(schema).parquet(out) if found else spark.createDataFrame([], schema)
