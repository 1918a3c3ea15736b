"""Stupid-backoff scores computed relationally: count tables of n-grams, joined to exploded n-grams, summed per document.

N-grams are hashes. :func:`count_table` counts those of one order, partitioned by hash, and
:func:`score_against` walks down the orders: what a document's n-grams find in a table is scored,
what they do not find goes on to the next lower order at a factor.

A corpus that is scored under its own counts finds everything, so :func:`score` needs one exchange and two orders:
with runs of n words, all but the first n - 1 words of a text score a run's count over that of the run without its last word, and what
the first ones score cancels down to one count. Runs of n words of documents are dealt by the hash of their first n - 1 words (the
stem), exploded and counted where they land, with and without their last word, and joined to both counts there. N-grams with more than a
stated share of all occurrences are counted ahead and known to every task (a share bounds their number), so none of them
fills a partition: what follows a known stem is dealt by the whole run. Shorter runs are counted
where they are a whole text; a bitmap of fixed size keeps nearly all others out of the exchange.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandcast.llm.common import map_arrow
from demandcast.llm.shingles import mix, text_groups, word_hashes
from demandcast.session import materialise

_U = np.uint64
#: Factor of a backed-off score.
ALPHA = 0.4
#: Stems with at least this share of all occurrences are known to every task: 65,000 at most.
KNOWN_SHARE = 1 / 65_000
#: A task that saw an n-gram less often proposes it only for a share that has to be known: small tasks see nearly all of theirs once.
SEEN = 4
#: Rows of one partition of exploded n-grams; bigrams with over a quarter of that are known to every task, too.
PARTITION_ROWS = 1_500_000
#: Bytes of text for each n-gram of a document, about; it sizes partitions only.
WORD_BYTES = 6
#: Bits of the bitmap of whole texts that are shorter than the runs: a megabyte, whatever their number.
SHORT_BITS = 23
#: White space and words, as the bytes of a text are cut.
_GAP, _WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"


def _order(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words."""
    size = max(len(words) - n + 1, 0)
    out = words[:size].copy()
    for i in range(1, n):
        out = mix(out * _U(0x9E3779B97F4A7C15) + words[i:size + i][:size] + _U(77 + i))
    return out


def _texts(batch: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(position of the first text, words of a group of texts, where each text's words begin and the last ends)."""
    for at, texts in text_groups(batch):
        words, start = word_hashes(np.frombuffer(b" ".join(texts), np.uint8))
        yield at, words, np.concatenate([[0], np.searchsorted(start, np.cumsum([len(t) + 1 for t in texts]))])


def _inside(bounds: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which runs of ``n`` words lie within one text."""
    fine = np.ones(max(total - n + 1, 0), bool)
    for back in range(1, n):
        cut = bounds[1:-1] - back
        fine[cut[(cut >= 0) & (cut < len(fine))]] = False
    return fine


class Frequent:
    """Lossy counting: every key with at least ``share`` of what was added is kept, its count short by a quarter of that at most."""

    def __init__(self, share: float):
        self.share, self.total = share, 0
        self.keys, self.counts = np.empty(0, _U), np.empty(0, np.int64)

    def add(self, keys: np.ndarray) -> None:
        self.total += len(keys)
        new, n = np.unique(keys, return_counts=True)
        self.keys, at = np.unique(np.concatenate([self.keys, new]), return_inverse=True)
        self.counts = np.bincount(at, np.concatenate([self.counts, n]), len(self.keys)).astype(np.int64)
        keep = self.counts > self.share / 4 * self.total
        self.keys, self.counts = self.keys[keep], self.counts[keep]


def frequent(docs: DataFrame, text: str, shares: dict[int, float], also: dict[int, np.ndarray] | None = None, more: dict[int, float] | None = None) -> dict[int, dict[int, int]]:
    """Per order of n-grams the exact counts of all those with at least the given share of occurrences, and more.

    A first pass keeps candidates per task, a second one counts them. A key whose share is s over all tasks
    has s/2 or more where tasks kept it, so candidates number at most 4 / share. ``more`` has smaller shares, from which on n-grams are
    given as well if tasks saw them ``SEEN`` times. ``also`` has sorted n-grams of other orders
    to be counted with them. The number of words is always given, as the total of order 1.
    """
    also, least = also or {}, {n: min(share, (more or {}).get(n, share)) for n, share in shares.items()}
    orders, every = sorted(shares), sorted({1, *shares, *also})
    source = docs.select(F.col(f"`{text}`").alias("t")).where("t IS NOT NULL")

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {n: Frequent(least[n] / 2) for n in orders}
        if 1 not in held:
            held[1] = Frequent(1.0)
        for batch in batches:
            for _, words, bounds in _texts(batch.column(0)):
                for n in orders:
                    held[n].add(_order(words, n)[_inside(bounds, n, len(words))])
                if 1 not in shares:
                    held[1].total += len(words)
        for n, f in held.items():
            worth = (f.counts >= SEEN) | (f.counts > shares.get(n, 1.0) / 8 * f.total)
            keys = np.concatenate([f.keys[worth].view(np.int64), [0]])
            yield pa.RecordBatch.from_arrays([pa.array([n] * len(keys), pa.int32()), pa.array(keys), pa.array(np.concatenate([f.counts[worth], [f.total]])),
                                              pa.array([False] * (len(keys) - 1) + [True])], ["n", "g", "c", "all"])

    parts = materialise(map_arrow(source, propose, "n int, g bigint, c bigint, all boolean").groupBy("n", "all", "g").agg(F.sum("c").alias("c")))
    totals = {r.n: r.c for r in parts.where("all").collect()}
    found = {n: np.sort(parts.where(~F.col("all") & (F.col("n") == n) & (F.col("c") >= least[n] / 4 * totals.get(n, 0))).select("g").toArrow()["g"].to_numpy().view(_U)) for n in orders}
    found |= {n: also.get(n, np.empty(0, _U)) for n in every if n not in shares}
    shared = docs.sparkSession.sparkContext.broadcast(found)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        sums = {n: np.zeros(len(wanted[n]) + 1, np.int64) for n in every if len(wanted[n])}
        for batch in batches:
            for _, words, bounds in _texts(batch.column(0)):
                for n in sums:
                    sums[n] += np.bincount(_place(wanted[n], _order(words, n)[_inside(bounds, n, len(words))]), minlength=len(sums[n]))
        for n in sums:
            at = np.flatnonzero(sums[n][:-1])
            yield pa.RecordBatch.from_arrays([pa.array([n] * len(at), pa.int32()), pa.array(wanted[n][at].view(np.int64)), pa.array(sums[n][at])], ["n", "g", "c"])

    rows = map_arrow(source, count, "n int, g bigint, c bigint").groupBy("n", "g").agg(F.sum("c").alias("c")).toArrow()
    shared.destroy()
    out: dict[int, dict] = {}
    n, g, c = (rows[k].to_numpy() for k in ("n", "g", "c"))
    for k in every:
        own = np.flatnonzero(n == k)
        keys = g[own].view(_U)
        order = np.argsort(keys)
        out[k] = {"keys": keys[order], "counts": c[own][order], "total": totals.get(k, 0)}
    return out


def _place(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Position of each value among sorted keys, their number where it is none of them."""
    if not len(keys):
        return np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return np.where(keys[at] == values, at, len(keys))


def _known_logs(table: dict, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which n-grams every task knows, and the logarithms of their counts (0 for the others)."""
    place = _place(table["keys"], grams)
    return place < len(table["keys"]), np.concatenate([np.log(table["counts"]), [0.0]])[place]


def short_texts(docs: DataFrame, text: str, below: int, share: float) -> tuple[dict[int, np.ndarray], np.ndarray | None]:
    """Whole texts of 1 to ``below`` - 1 words: per number of words those with at least ``share`` of all such texts, and a bitmap of all of them (None without any)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, words, bounds in _texts(batch.column(0)):
                for n in range(1, below):
                    g, c = np.unique(_order(words, n)[bounds[:-1][np.diff(bounds) == n]], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([n] * len(g), pa.int32()), pa.array(g.view(np.int64)), pa.array(_slot(mix(g + _U(n))).astype(np.int32)), pa.array(c.astype(np.int64))], ["n", "g", "slot", "c"])

    # Few texts reach the workers: a longer one is told by its first words.
    long = f"^{_GAP}*+(?:{_WORD}++{_GAP}++){{{below - 1}}}{_WORD}"
    source = docs.select(F.col(f"`{text}`").cast("string").alias("t")).where("t IS NOT NULL").where(~F.col("t").rlike(long))
    rows = materialise(map_arrow(source, run, "n int, g bigint, slot int, c bigint").groupBy("n", "g", "slot").agg(F.sum("c").alias("c")))
    total = rows.agg(F.sum("c")).first()[0]
    if not total:
        return {}, None
    often = rows.where(F.col("c") >= share * total).select("n", "g").toArrow()
    n, g = (often[k].to_numpy() for k in ("n", "g"))
    words = rows.groupBy(F.shiftright("slot", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, slot & 63)")).alias("bits")).toArrow()
    bits = np.zeros(1 << SHORT_BITS - 6, _U)
    bits[words["at"].to_numpy()] = words["bits"].to_numpy().view(_U)
    return {k: np.sort(g[n == k].view(_U)) for k in range(1, below)}, bits


def _slot(g: np.ndarray) -> np.ndarray:
    """Place of a hash in the bitmap of short texts."""
    return g >> _U(64 - SHORT_BITS)


def dealt(docs: DataFrame, text: str, key: str, known: dict[int, dict], parts: int, order: int = 2, short: np.ndarray | None = None) -> DataFrame:
    """(part, g, h, doc, times, weight): n-grams of a run of documents with one remainder of their hash, as arrays.

    ``g`` is a stem (a run of ``order`` - 1 words) and ``h`` the word after it, or ``g`` the whole run and ``h`` 0 where every task knows
    the stem's count; without ``h`` a row concerns ``g`` alone. ``times`` adds to the counts of both. The document gets the logarithm of the whole run's
    count so often, less that of the stem's, and the logarithm of the count of ``g`` ``weight`` times more: once where a stem begins the
    text or a shorter run is the text. Where the bitmap ``short`` has them, the other occurrences of
    shorter runs come once for the run of documents, for no document. What the counts known to every task give is one more entry
    per document, with the number of words below 0 as ``times``. Arrays spare the exchange what a row costs beside its hashes.
    """
    shared = docs.sparkSession.sparkContext.broadcast((known, short))
    stem = order - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, bits = shared.value
        log_total = math.log(max(tables[1]["total"], 1))
        for batch in batches:
            every = batch.column(0).cast(pa.int64())
            ids, null = every.fill_null(0).to_numpy(zero_copy_only=False), every.is_null().to_numpy(zero_copy_only=False)
            for at, words, bounds in _texts(batch.column(1)):
                n_docs = len(bounds) - 1
                size = np.diff(bounds)
                doc = np.repeat(np.arange(n_docs), size)
                start = np.flatnonzero(_inside(bounds, order, len(words)))
                grams = _order(words, order)[start]
                known_gram, logs = _known_logs(tables[order], grams)
                # Word by word, so that what nearly cancels is subtracted before it is added up.
                value = np.zeros(len(words))
                value[start] = logs
                # Orders share a table: they are told from each other by another mix. Rows are (g, h, no h, document, times, weight).
                rows = []
                if stem:
                    stems = _order(words, stem)
                    known_stem, stem_log = _known_logs(tables[stem], stems)
                    value[start] -= stem_log[start]
                    enough = size >= stem
                    first, last = bounds[:-1][enough], bounds[1:][enough] - stem
                    begins = np.zeros(len(stems))
                    begins[first] = 1
                    # Followed by a word whose run is to be counted, or by one whose run is known, or by none.
                    follows = start[~known_stem[start] & ~known_gram]
                    rows.append((mix(stems[follows] + _U(stem)), np.maximum(words[follows + stem], _U(1)), False, doc[follows], 1, begins[follows]))
                    bare = start[~known_stem[start] & known_gram]
                    rows.append((mix(stems[bare] + _U(stem)), 0, True, doc[bare], 1, begins[bare] - 1))
                    ends = last[~known_stem[last]]
                    rows.append((mix(stems[ends] + _U(stem)), 0, True, doc[ends], 1, begins[ends]))
                    alone = known_stem[start] & ~known_gram
                else:
                    alone = ~known_gram
                rows.append((mix(grams[alone] + _U(order)), 0, False, doc[start[alone]], 1, 0.0))
                s = np.bincount(doc, value, n_docs).astype(np.float64)
                if stem:
                    s[enough] += stem_log[first] - log_total
                else:
                    s -= size * log_total
                for n in range(1, stem) if bits is not None else ():
                    whole = np.flatnonzero(size == n)
                    runs = _order(words, n)
                    own, logs = _known_logs(tables[n], runs)
                    begin = bounds[whole]
                    s[whole] += logs[begin] - log_total
                    whole, begin = whole[~own[begin]], begin[~own[begin]]
                    rows.append((mix(runs[begin] + _U(n)), 0, True, whole, 1, 1.0))
                    others = _inside(bounds, n, len(words)) & ~own
                    others[begin] = False
                    g = mix(runs[others] + _U(n))
                    slot = _slot(g)
                    g, times = np.unique(g[(bits[slot >> _U(6)] >> (slot & _U(63))) & _U(1) == 1], return_counts=True)
                    rows.append((g, 0, True, n_docs, times, 0.0))
                rows.append((mix(ids[at:at + n_docs].view(_U) + _U(991)), 0, True, np.arange(n_docs), -1 - size, s))
                g, h, bare, d, times, w = (np.concatenate([np.broadcast_to(np.asarray(r[i], kind), r[0].shape) for r in rows]) for i, kind in enumerate((_U, _U, bool, np.int64, np.int64, np.float64)))
                part = g % _U(parts)
                # By part and document; the hashes' high bits bring the repeats of a document together, nearly all of them.
                by = np.argsort((part << _U(44)) | (d.astype(_U) << _U(22)) | ((g ^ h) >> _U(42)), kind="stable")
                g, h, bare, d, w, times, part = (x[by] for x in (g, h, bare, d, w, times, part.astype(np.int64)))
                new = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (h[1:] != h[:-1]) | (bare[1:] != bare[:-1]) | (d[1:] != d[:-1])]))
                g, h, bare, d, part, times, w = g[new], h[new], bare[new], d[new], part[new], np.add.reduceat(times, new), np.add.reduceat(w, new)
                cut = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]]).astype(np.int32)
                # The last place is that of no document.
                own_ids, own_null = np.append(ids[at:at + n_docs], 0), np.append(null[at:at + n_docs], True)
                lists = [pa.array(g.view(np.int64)), pa.array(h.view(np.int64), mask=bare), pa.array(own_ids[d], mask=own_null[d]), pa.array(times.astype(np.int32)), pa.array(w)]
                yield pa.RecordBatch.from_arrays([pa.array(part[cut[:-1]], pa.int32()), *[pa.ListArray.from_arrays(cut, x) for x in lists]], ["part", "g", "h", "doc", "times", "weight"])

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("t"))
    return map_arrow(rows, run, "part int, g array<bigint>, h array<bigint>, doc array<bigint>, times array<int>, weight array<double>")


def score(docs: DataFrame, text: str = "text", key: str = "doc_id", partition_rows: int = PARTITION_ROWS, order: int = 2) -> DataFrame:
    """(key, n_words, log_score, mean_score) of every document under the counts of runs of up to ``order`` words of all documents.

    Words are lower-cased (A-Z) runs without white space. A word scores the count of the run of ``order`` words that ends with it over the
    count of that run without it; at the beginning of a text the run is as long as the text allows, and the first word scores
    c(w)/N. With 2, that is c(vw)/c(v) for any other word. Every count above 0 counts as seen, and a document's own runs are
    among those counted, so none is backed off. Natural logarithms
    are added up. Texts without words (and NULL) have a score of 0 and a NULL mean. Rows that repeat
    a key count as one document; rows with a NULL key add to the counts and are not returned. An empty table gives no rows.
    A text of any length is hashed whole; a partition holds about ``partition_rows`` n-grams of documents.
    """
    if order < 1:
        raise ValueError("order is the number of words of a run, at least 1")
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    parts = max(8, math.ceil(size / WORD_BYTES / partition_rows))
    share = 1 / (4 * parts)
    also, short = short_texts(docs, text, order - 1, share) if order > 2 else ({}, None)
    known = frequent(docs, text, {order: share, max(order - 1, 1): share}, also, {max(order - 1, 1): KNOWN_SHARE})
    for n in range(1, order - 1):
        known.setdefault(n, {"keys": np.empty(0, _U), "counts": np.empty(0, np.int64), "total": 0})
    # Several remainders to a partition even out how the exchange deals them.
    moved = dealt(docs, text, key, known, 4 * parts, order, short).repartition(parts, "part")
    rows = moved.select("part", F.inline(F.arrays_zip("g", "h", "doc", "times", "weight")))
    # The count tables of a partition and their join to the n-grams in one pass: every remainder is whole here. Sorted by hash
    # first, whose 64 bits decide nearly every comparison, and by the next word, so that one sort serves both counts.
    times, same = F.greatest("times", F.lit(0)), Window.partitionBy("g", "part")
    counted = rows.withColumns({"n": F.sum(times).over(same.orderBy("h").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
                                "m": F.sum(times).over(Window.partitionBy("g", "part", "h"))}).where("doc IS NOT NULL")
    own = F.col("times") < 0
    run = F.when(F.col("h") != 0, F.log("m") - F.log("n")).when(F.col("h") == 0, F.log("m")).otherwise(0.0)
    each = counted.groupBy("doc").agg(
        F.sum(F.when(own, -1 - F.col("times")).otherwise(0)).cast("bigint").alias("n_words"),
        F.sum(F.when(own, F.col("weight")).otherwise(F.col("times") * run + F.when(F.col("weight") != 0, F.col("weight") * F.log("n")).otherwise(0.0))).alias("log_score"))
    return each.select(F.col("doc").alias(key), "n_words", "log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")).alias("mean_score"))


# --- count tables of any order, and texts from elsewhere ------------------------------------

def positions(docs: DataFrame, text: str, key: str, order: int) -> DataFrame:
    """(doc, n_words, g, c, times): the words of a text with the runs that end with them and with the word before.

    Element n - 1 of ``g`` and ``c`` is the run of n words; both are shorter at the beginning of a text. Equal rows of a text
    are one with their number as ``times``; a row with 0 carries the number of words.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for at, words, bounds in _texts(batch.column(1)):
                docs_, grams, before, times, sizes = [], [], [], [], []
                for d, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])):
                    runs = [_order(words[lo:hi], n).view(np.int64).tolist() for n in range(1, order + 1)]
                    seen: dict[tuple, int] = {}
                    for i in range(hi - lo):
                        own = tuple(tuple(runs[n - 1][j - n + 1] for n in range(1, min(order, j + 1) + 1)) for j in (i, i - 1))
                        seen[own] = seen.get(own, 0) + 1
                    for (g, c), n in [(((), ()), 0), *seen.items()]:
                        docs_.append(at + d)
                        grams.append(g)
                        before.append(c)
                        times.append(n)
                        sizes.append(0 if n else hi - lo)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(docs_, pa.int64())), pa.array(sizes, pa.int64()), pa.array(grams, pa.list_(pa.int64())),
                                                  pa.array(before, pa.list_(pa.int64())), pa.array(times, pa.int64())], ["doc", "n_words", "g", "c", "times"])

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("t"))
    return map_arrow(rows, run, "doc bigint, n_words bigint, g array<bigint>, c array<bigint>, times bigint")


def count_table(docs: DataFrame, n: int, text: str = "text") -> DataFrame:
    """(g, n): occurrences of every run of ``n`` words, counted per task before they move, written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, words, bounds in _texts(batch.column(0)):
                keys, c = np.unique(_order(words, n)[_inside(bounds, n, len(words))], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(c.astype(np.int64))], ["g", "n"])

    source = docs.select(F.col(f"`{text}`").alias("t")).where("t IS NOT NULL")
    return materialise(map_arrow(source, run, "g bigint, n bigint").groupBy("g").agg(F.sum("n").alias("n")))


def score_against(docs: DataFrame, tables: Sequence[DataFrame], text: str = "text", key: str = "doc_id", alpha: float = ALPHA) -> DataFrame:
    """(key, n_words, log_score, mean_score) of texts under the count tables of orders 1, 2, ... of any corpus.

    A word scores the count of its longest run that the tables hold over that of the run without it, times
    ``alpha`` for each order above that it was not found in, starting with the longest run that the text allows. A
    word unknown to the tables counts as one half. With tables of nothing every score is NULL. NULL keys are not returned.
    """
    order = len(tables)
    total = tables[0].agg(F.sum("n").alias("n")).first()[0]
    base = F.lit(math.log(total) if total else None).cast("double")
    rows = materialise(positions(docs, text, key, order).where("doc IS NOT NULL"))
    open_ = rows.where("times > 0").withColumn("_back", F.lit(0))
    parts = []
    for n in range(order, 0, -1):
        # Runs that are shorter than the order, at the beginning of a text, wait for theirs without a factor.
        asked = open_.where(F.size("g") >= n).withColumn("_g", F.get("g", F.lit(n - 1)))
        counts = tables[n - 1].select(F.col("g").alias("_g"), F.col("n").alias("_n"))
        found = materialise(asked.join(counts, "_g", "left"))
        factor = F.col("_back") * math.log(alpha)
        if n == 1:
            parts.append(found.select("doc", (F.col("times") * (F.log(F.coalesce("_n", F.lit(0.5))) + factor - base)).alias("s")))
            break
        hit = found.where("_n IS NOT NULL").withColumn("_c", F.get("c", F.lit(n - 2)))
        under = tables[n - 2].select(F.col("g").alias("_c"), F.col("n").alias("_m"))
        parts.append(hit.join(under, "_c", "left").select("doc", (F.col("times") * (F.log("_n") - F.log("_m") + factor)).alias("s")))
        open_ = open_.where(F.size("g") < n).unionByName(found.where("_n IS NULL").withColumn("_back", F.col("_back") + 1).drop("_g", "_n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    size = rows.groupBy("doc").agg(F.sum("n_words").alias("n_words"))
    each = out.groupBy("doc").agg(F.sum("s").alias("_s"))
    return size.join(each, "doc", "left").select(
        F.col("doc").alias(key), "n_words", F.when(F.col("n_words") > 0, F.col("_s")).otherwise(0.0).alias("log_score"),
        F.when(F.col("n_words") > 0, F.col("_s") / F.col("n_words")).alias("mean_score"))
