"""Language identification by prediction by partial matching with frozen statistics.

One variable-order byte context tree per language, all of them held in shared node tables: a
node is a string of up to ``order + 1`` bytes, with one code length per language. The code
length of a byte is that of the longest context in which the language has seen it, plus the
escapes from the longer ones (escape method C). As statistics are frozen after training, a
node's code length is one number per language, so scoring a text is one table lookup per byte;
only bytes never seen in their full context walk down to shorter ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandcast.llm.common import map_arrow
from demandcast.session import materialise

#: Bytes of context at most.
ORDER = 4
#: Documents per language to learn from, about; drawn by a hash of their text.
TRAIN_DOCS = 3000
#: Bytes scored at a time.
CHUNK = 1 << 19

UNDETERMINED = "und"
_LETTER = re.compile(r"[^\W\d_]")
_U = np.uint64


def normal(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


def grams(data: np.ndarray, n: int) -> np.ndarray:
    """All n-byte strings of a byte array as integers, first byte highest."""
    m = len(data) - n + 1
    if m <= 0:
        return np.empty(0, _U)
    out = data[:m].astype(_U)
    for i in range(1, n):
        out = (out << _U(8)) | data[i:i + m]
    return out


# --- counting -----------------------------------------------------------------------------

def gram_counts(docs: DataFrame, text: str, lang: str, order: int = ORDER) -> DataFrame:
    """(lang, length, gram, n): byte strings of 1..order+1 bytes over whole texts.

    Every task counts its own rows first, so what moves is one row per distinct string and task.
    """
    lead = b"\n" * order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}
        waiting: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def count(name: str) -> None:
            texts = waiting.pop(name)
            data = np.frombuffer(b"".join(x for t in texts for x in (lead, t)), np.uint8)
            # Only strings that end in a text's own bytes count, so texts do not touch each other.
            own = np.ones(len(data), bool)
            begins = np.cumsum([0, *[len(t) + order for t in texts[:-1]]])
            own[(begins[:, None] + np.arange(order)).reshape(-1)] = False
            size[name] = 0
            for n in range(1, order + 2):
                keys, c = np.unique(grams(data, n)[own[n - 1:]], return_counts=True)
                if (name, n) in held:
                    k0, c0 = held[name, n]
                    keys, at = np.unique(np.concatenate([k0, keys]), return_inverse=True)
                    c = np.bincount(at, np.concatenate([c0, c]), len(keys)).astype(np.int64)
                held[name, n] = keys, c.astype(np.int64)

        for batch in batches:
            for t, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = normal(t)
                waiting.setdefault(name, []).append(raw)
                size[name] = size.get(name, 0) + len(raw)
                if size[name] > 4 * CHUNK:
                    count(name)
        for name in list(waiting):
            count(name)
        for (name, n), (keys, c) in held.items():
            for at in range(0, len(keys), 100_000):
                part = keys[at:at + 100_000].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(part)), pa.array(np.full(len(part), n, np.int32)), pa.array(part),
                     pa.array(c[at:at + 100_000])], ["lang", "length", "gram", "n"])

    rows = docs.select(F.col(f"`{text}`").alias("t"), F.col(f"`{lang}`").alias("l")).where("t IS NOT NULL AND l IS NOT NULL")
    parts = map_arrow(rows, run, "lang string, length int, gram bigint, n bigint")
    return parts.groupBy("lang", "length", "gram").agg(F.sum("n").alias("n"))


def training_sample(docs: DataFrame, lang: str, key: str, per_lang: int = TRAIN_DOCS) -> DataFrame:
    """About ``per_lang`` documents of each language, or all if it has fewer.

    A row is taken when a hash of its key falls below its language's rate, so the draw needs no
    sort, no shuffle of texts, and is the same on every retry.
    """
    counts = {r[0]: r[1] for r in docs.groupBy(F.col(f"`{lang}`")).count().collect() if r[0] is not None}
    rate = F.lit(0.0)
    for name, n in counts.items():
        rate = F.when(F.col(f"`{lang}`") == name, min(1.0, per_lang / n)).otherwise(rate)
    draw = F.pmod(F.xxhash64(F.lit("ppm"), F.col(f"`{key}`")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return docs.where(draw < rate)


# --- model --------------------------------------------------------------------------------

class Lookup:
    """Position of integer keys, by cuckoo hashing in two arrays: two probes per key, vectorised."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 2))))
        rng = np.random.default_rng(len(keys))
        while True:
            self.shift = _U(64 - bits)
            self.mult = rng.integers(1, 1 << 63, 2, dtype=np.uint64) * _U(2) + _U(1)
            if self._place(bits):
                break
            bits += 1
        self.stored = [np.where(s >= 0, keys[np.maximum(s, 0)], ~_U(0)) if len(keys) else np.full(len(s), ~_U(0))
                       for s in self.slots]

    def _hash(self, keys: np.ndarray, which: int) -> np.ndarray:
        h = keys * self.mult[which]
        return ((h ^ (h >> _U(29))) * self.mult[1 - which] >> self.shift).astype(np.int64)

    def _place(self, bits: int) -> bool:
        self.slots = [np.full(1 << bits, -1, np.int32) for _ in range(2)]
        pending, which = np.arange(len(self.keys), dtype=np.int32), 0
        for _ in range(200):
            if not len(pending):
                return True
            slots, h = self.slots[which], self._hash(self.keys[pending], which)
            before = slots[h]
            slots[h] = pending
            lost = pending[slots[h] != pending]
            evicted = np.unique(before[before >= 0])
            pending, which = np.concatenate([lost, evicted]).astype(np.int32), 1 - which
        return False

    def find(self, keys: np.ndarray) -> np.ndarray:
        h = self._hash(keys, 0)
        at = np.where(self.stored[0][h] == keys, self.slots[0][h], -1)
        miss = np.flatnonzero(at < 0)
        if len(miss):
            k = keys[miss]
            h = self._hash(k, 1)
            at[miss] = np.where(self.stored[1][h] == k, self.slots[1][h], -1)
        return at


@dataclass
class Model:
    """Code lengths in bits: nodes[k] are strings of k + 1 bytes, contexts[k] of k bytes."""

    langs: list[str]
    order: int
    first: np.ndarray
    nodes: dict[int, Lookup]
    cost: dict[int, np.ndarray]
    contexts: dict[int, Lookup]
    escape: dict[int, np.ndarray]

    def lengths(self, keys: np.ndarray, k: int) -> np.ndarray:
        """(len(keys), languages): bits of the last byte of each key after the k bytes before it."""
        if k == 0:
            return self.first[keys.astype(np.int64)]
        at = self.nodes[k].find(keys)
        out = self.cost[k][at]  # where at is -1 this is overwritten below
        miss = np.flatnonzero(at < 0)
        if len(miss):
            context = self.contexts[k].find(keys[miss] >> _U(8))
            out[miss] = np.where((context >= 0)[:, None], self.escape[k][context], 0) + self.lengths(
                keys[miss] & _U((1 << (8 * k)) - 1), k - 1)
        return out

    def bits(self, data: bytes) -> np.ndarray:
        """Code length of one whole text in every language, in chunks of bounded size."""
        total = np.zeros(len(self.langs))
        raw = np.frombuffer(b"\n" * self.order + data, np.uint8)
        for at in range(0, len(data), CHUNK):
            keys = grams(raw[at:at + CHUNK + self.order], self.order + 1)
            total += self.lengths(keys, self.order).sum(axis=0, dtype=np.float64)
        return total

    def bits_many(self, texts: list[bytes]) -> np.ndarray:
        """Code lengths of many short texts, scored as one array."""
        lead = b"\n" * self.order
        raw = np.frombuffer(b"".join(x for t in texts for x in (lead, t)), np.uint8)
        each = self.lengths(grams(raw, self.order + 1), self.order)
        ends = np.cumsum([len(t) + self.order for t in texts])
        sums = np.zeros((len(each) + 1, len(self.langs)))
        np.cumsum(each, axis=0, dtype=np.float64, out=sums[1:])
        # A text of n bytes owns the n strings that end in its own bytes.
        return sums[ends - self.order] - sums[ends - self.order - np.array([len(t) for t in texts])]


def build_model(names: np.ndarray, length: np.ndarray, gram: np.ndarray, n: np.ndarray, order: int = ORDER) -> Model:
    """Code lengths from columns of (lang, length, gram, n); languages in alphabetical order."""
    langs = sorted(set(names.tolist()))
    who = np.searchsorted(langs, names) if langs else np.empty(0, np.int64)
    gram, n = gram.astype(np.int64).view(_U), n.astype(np.float64)
    model = Model(langs, order, np.full((256, len(langs)), 8.0, np.float32), {}, {}, {}, {})
    for k in range(order + 1):
        mine = length == k + 1
        keys, at = np.unique(gram[mine], return_inverse=True)
        seen = np.zeros((len(keys), len(langs)))
        seen[at, who[mine]] = n[mine]
        context, under = np.unique(keys >> _U(8), return_inverse=True)
        total, kinds = np.zeros((len(context), len(langs))), np.zeros((len(context), len(langs)))
        np.add.at(total, under, seen)
        np.add.at(kinds, under, seen > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
            own = -np.log2(seen / (total + kinds)[under])
        if k == 0:
            lower = np.full((len(keys), len(langs)), 8.0)
            if len(context):
                model.first += escape[0].astype(np.float32)
            model.first[keys.astype(np.int64)] = np.where(seen > 0, own, escape[under] + lower)
        else:
            lower = model.lengths(keys & _U((1 << (8 * k)) - 1), k - 1)
            model.nodes[k], model.contexts[k] = Lookup(keys), Lookup(context)
            # One spare row, so that position -1 is valid for strings that are not there.
            model.cost[k] = np.vstack([np.where(seen > 0, own, escape[under] + lower), np.zeros((1, len(langs)))]).astype(np.float32)
            model.escape[k] = np.vstack([escape, np.zeros((1, len(langs)))]).astype(np.float32)
    return model


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", order: int = ORDER,
          per_lang: int = TRAIN_DOCS) -> Model:
    """A frozen model from rows with text and language; rows without either teach nothing.

    Counts are summed by Spark over about ``per_lang`` documents of each language; the driver gets every
    string of theirs, so code lengths are exact for that sample, which is the only bound.
    """
    known = docs.where(F.col(f"`{text}`").isNotNull() & F.col(f"`{lang}`").isNotNull())
    counts = materialise(gram_counts(training_sample(known, lang, key, per_lang), text, lang, order))
    # As Arrow columns: a Python object per node would take ten times the model's memory on the driver.
    parts = [counts.where(F.col("length") == n).toArrow() for n in range(1, order + 2)]
    whole = pa.concat_tables(parts)
    langs = pc.dictionary_encode(whole["lang"]).combine_chunks()
    words = np.array(langs.dictionary.to_pylist(), dtype=np.str_)
    names = words[langs.indices.to_numpy()] if len(words) else np.empty(0, np.str_)
    return build_model(names, *[whole[c].to_numpy() for c in ("length", "gram", "n")], order)


# --- prediction ---------------------------------------------------------------------------

def identify(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None,
             lang_pred: str = "lang_pred", score: str = "score", bits: str = "bits_per_byte") -> DataFrame:
    """Add the language with the shortest code, its posterior share, and its bits per byte.

    ``score`` is 2^-length of the best language over the sum for all. NULL texts, texts without
    a letter, and any text when nothing was learned are ``und`` with score 0 and NULL bits.
    Rows are independent; ``keep`` lists input columns to pass through (default: all).
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in (lang_pred, score, bits)]
    # A text that is passed through travels once.
    extra = [] if text in kept else [docs[f"`{text}`"].alias("_lid_text")]
    place = kept.index(text) if text in kept else len(kept)
    source = docs.select(*[docs[f"`{c}`"] for c in kept], *extra)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:len(kept)]]
                       + [f"`{lang_pred}` string", f"`{score}` double", f"`{bits}` double"])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        for batch in batches:
            rows = batch.num_rows
            total = np.full((rows, len(m.langs)), np.nan)
            sizes = np.zeros(rows)
            group: list[tuple[int, bytes]] = []

            def flush() -> None:
                if group:
                    total[[i for i, _ in group]] = m.bits_many([d for _, d in group])
                    group.clear()

            held = 0
            for i in range(rows):
                t = batch.column(place)[i].as_py()
                if not m.langs or not t or not _LETTER.search(t):
                    continue
                data = normal(t)
                sizes[i] = len(data)
                if len(data) > CHUNK:
                    total[i] = m.bits(data)
                    continue
                if held + len(data) > CHUNK:
                    flush()
                    held = 0
                group.append((i, data))
                held += len(data)
            flush()
            best = np.zeros(rows, np.int64)
            share, per_byte = np.zeros(rows), np.full(rows, np.nan)
            fine = np.flatnonzero(sizes > 0)
            if len(fine):
                mine = total[fine]
                best[fine] = mine.argmin(axis=1)
                least = mine.min(axis=1)
                share[fine] = 1.0 / np.exp2(np.maximum(least[:, None] - mine, -1000.0)).sum(axis=1)
                per_byte[fine] = least / sizes[fine]
            names = [m.langs[b] if s > 0 else UNDETERMINED for b, s in zip(best, sizes)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(kept)], pa.array(names, pa.string()), pa.array(share),
                 pa.array(per_byte, mask=np.isnan(per_byte))], [*kept, lang_pred, score, bits])

    return map_arrow(source, run, schema)


def held_out(key: Column, folds: int, fold: int) -> Column:
    """True for rows whose crc32 of the key as text leaves ``fold`` when divided by ``folds``."""
    return F.crc32(key.cast("string").cast("binary")) % folds == fold
