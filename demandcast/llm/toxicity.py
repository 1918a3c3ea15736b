"""Toxicity through a noisy channel: restore obfuscated words, then score the restored text.

A token that carries substituted characters, separators between single letters or stretched
letters is a lattice of readings; Viterbi picks the reading with the least cost under a
character language model counted over the whole corpus plus the channel's costs. Scores come
from a lexicon of words and word beginnings learned from labelled documents.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.llm.common import map_arrow
from demandcast.llm.shingles import text_groups

#: Letters that a character may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a",
        "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "{": "c", "€": "e", "£": "l", "#": "h"}
#: Channel costs in nats: a substituted letter, a dropped separator, a separator kept as a word end, a shortened run.
SUBSTITUTED, DROPPED, KEPT, SHORTENED, MASKED = 0.7, 0.6, 1.5, 0.3, 3.0
#: Labelled documents per label to learn from, at most about; drawn by a hash of the key.
TRAIN_DOCS = 12_000
#: Lengths of word beginnings that may be entries.
STEMS = (4, 5, 6)
#: Remembered words of a worker before it forgets them.
MEMORY = 200_000

SYMBOLS = 28  # boundary, a-z, any other letter
_EDGE = "".join(chr(i) for i in range(33, 127) if not chr(i).isalnum()) + "«»…‘’“”¿¡"
_SPACED = re.compile(r"(?<!\S)\S(?:[ \t]{1,2}\S){2,}(?!\S)")
_STRETCHED = re.compile(r"(.)\1\1")
_RUN = re.compile(r"(.)\1+")

_CODE = np.zeros(256, np.int64)
_CODE[97:123] = np.arange(1, 27)
_CODE[65:91] = np.arange(1, 27)
_CODE[128:] = 27


def code(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27 if c.isalpha() else 0


# --- character model ------------------------------------------------------------------------

def char_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of four-symbol strings over all texts: at most 28^4 numbers, whatever the corpus."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS ** 4, np.int64)
        for batch in batches:
            for _, texts in text_groups(batch.column(0)):
                c = _CODE[np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)]
                # Runs of boundaries count once.
                c = c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])]
                if len(c) > 3:
                    total += np.bincount(((c[:-3] * SYMBOLS + c[1:-2]) * SYMBOLS + c[2:-1]) * SYMBOLS + c[3:], minlength=SYMBOLS ** 4)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["gram", "n"])

    parts = map_arrow(docs.select(F.col(f"`{text}`").alias("t")).where("t IS NOT NULL"), run, "gram int, n bigint")
    rows = parts.groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(SYMBOLS ** 4)
    out[rows["gram"].to_numpy(np.int64)] = rows["n"].to_numpy(np.float64)
    return out


def char_model(counts: np.ndarray) -> np.ndarray:
    """-log P(symbol | three before), each order mixed with the next lower one."""
    four = counts.reshape((SYMBOLS,) * 4)
    p = np.full(SYMBOLS, 1.0 / SYMBOLS)
    for order in range(4):
        c = four.sum(axis=tuple(range(3 - order)))
        total, kinds = c.sum(axis=-1, keepdims=True), (c > 0).sum(axis=-1, keepdims=True)
        p = (c + (kinds + 1) * p) / (total + kinds + 1)
    return (-np.log(p)).astype(np.float32)


def readings(token: str) -> list[list[tuple[str, float]]]:
    """The lattice of a lower-cased token: per position, letters (or "" and " ") with channel costs."""
    out: list[list[tuple[str, float]]] = []
    at = 0
    while at < len(token):
        c = token[at]
        end = at + 1
        while end < len(token) and token[end] == c:
            end += 1
        n = end - at
        if c.isalpha() or c in LEET:
            letters = [(c, 0.0)] if c.isalpha() else [(x, SUBSTITUTED) for x in LEET[c]]
            first = list(letters)
            if not c.isalpha():
                first.append((" ", KEPT))
                if not c.isdigit():
                    first.append(("", DROPPED))
            out.append(first)
            if n > 1:
                again = [(x, 0.1) for x, _ in letters]
                out.append([("", SHORTENED), *again])
        elif c == "*":
            out.append([("", DROPPED), (" ", KEPT), *[(x, MASKED) for x in "abcdefghijklmnopqrstuvwxyz"]])
        elif c.isspace() and n > 1:
            out.append([(" ", 0.0)])
        else:
            out.append([("", DROPPED), (" ", KEPT)])
        at = end
    return out


#: Masked characters from which a token is decoded on arrays, and positions between two stored rows of costs.
MASKS, STRIDE = 4, 64


def restore(token: str, model: np.ndarray) -> str:
    """The reading of least cost; exact, as the model looks at three symbols back."""
    if token.count("*") >= MASKS:
        return restore_dense(readings(token), model)
    best: dict[tuple[int, int, int], tuple[float, str]] = {(0, 0, 0): (0.0, "")}
    for options in readings(token):
        new: dict[tuple[int, int, int], tuple[float, str]] = {}
        for (a, b, c), (cost, text) in best.items():
            for letter, price in options:
                if letter == "" or (letter == " " and c == 0):
                    key, total, out = (a, b, c), cost + price, text
                else:
                    s = code(letter)
                    key, total, out = (b, c, s), cost + price + float(model[a, b, c, s]), text + letter
                old = new.get(key)
                if old is None or total < old[0] or (total == old[0] and out < old[1]):
                    new[key] = total, out
        best = new
    return min((cost + (float(model[a, b, c, 0]) if c else 0.0), text) for (a, b, c), (cost, text) in best.items())[1].strip()


def _step(cost: np.ndarray, options: list[tuple[str, float]], model: np.ndarray, back: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Costs of all states after one position; with ``back`` the symbol that left each state, or -1 where it stayed."""
    new = np.full(cost.shape, np.inf)
    stayed = min((p for x, p in options if x == ""), default=np.inf)
    new = np.minimum(new, cost + stayed)
    # A space after a boundary, or at the beginning, changes nothing.
    space = min((p for x, p in options if x == " "), default=np.inf)
    new[:, :, 0] = np.minimum(new[:, :, 0], cost[:, :, 0] + space)
    came = np.full(cost.shape, -1, np.int8) if back else None
    by_symbol: dict[int, float] = {}
    for x, p in options:
        if x:
            by_symbol[code(x)] = min(p, by_symbol.get(code(x), np.inf))
    symbols = np.array(sorted(by_symbol), int)
    if len(symbols):
        moved = cost[:, :, :, None] + model[:, :, :, symbols]
        if 0 in by_symbol:
            moved[:, :, 0, np.searchsorted(symbols, 0)] = np.inf
        least = moved.min(axis=0) + np.array([by_symbol[x] for x in symbols.tolist()])
        better = least < new[:, :, symbols]
        if back:
            at = came[:, :, symbols]
            at[better] = moved.argmin(axis=0)[better]
            came[:, :, symbols] = at
        new[:, :, symbols] = np.where(better, least, new[:, :, symbols])
    return new, came


def restore_dense(lattice: list[list[tuple[str, float]]], model: np.ndarray) -> str:
    """The same by arrays over all states, in time and memory linear in the token.

    Rows of costs are kept every ``STRIDE`` positions and the way back is found stretch by stretch. The state is
    (two before, one before, last); what entered it is the last symbol, what left it the one before those three.
    """
    cost = np.full(model.shape[:3], np.inf)
    cost[0, 0, 0] = 0.0
    kept = []
    for n, options in enumerate(lattice):
        if n % STRIDE == 0:
            kept.append(cost)
        cost, _ = _step(cost, options, model, False)
    ends = cost + np.where(np.arange(model.shape[2]) > 0, model[:, :, :, 0], 0.0)
    a, b, c = (int(x) for x in np.unravel_index(ends.argmin(), ends.shape))
    out: list[str] = []
    for n in reversed(range(len(kept))):
        stretch = lattice[n * STRIDE:(n + 1) * STRIDE]
        row, came = kept[n], []
        for options in stretch:
            row, left = _step(row, options, model, True)
            came.append(left)
        for options, left in zip(reversed(stretch), reversed(came)):
            before = int(left[a, b, c])
            if before >= 0:
                out.append(min((p, x) for x, p in options if x and code(x) == c)[1])
                a, b, c = before, a, b
    return "".join(reversed(out)).strip()


def is_odd(word: str) -> bool:
    """Whether a lower-cased token without edge punctuation has more than one reading worth trying."""
    if word.isalpha():
        return _STRETCHED.search(word) is not None
    return any(c.isalpha() for c in word)


def trimmed(token: str) -> str:
    """Without punctuation at its ends; a single @, $ or ! before a letter may be a letter and stays."""
    core = token.strip(_EDGE)
    at = token.find(core) if core else 0
    return token[at - 1] + core if at and token[at - 1] in "@$!" and (at == 1 or token[at - 2] != token[at - 1]) else core


class Restorer:
    """Restores tokens and spaced runs, remembering what it has seen."""

    def __init__(self, model: np.ndarray):
        self.model, self.known = model, {}

    def words(self, token: str) -> list[str]:
        """Restored words of one lower-cased token."""
        word = trimmed(token)
        if not word or not is_odd(word):
            return [word] if word else []
        got = self.known.get(word)
        if got is None:
            if len(self.known) > MEMORY:
                self.known.clear()
            got = self.known[word] = restore(word, self.model).split()
        return got

    def spaced(self, text: str) -> list[str]:
        """Words found in runs of single characters; runs of one or two different ones are noise."""
        out: list[str] = []
        for m in _SPACED.finditer(text):
            run = m.group()
            if len(set(run) - {" ", "\t"}) > 2:
                out += restore(run.replace("\t", " "), self.model).split()
        return out

    def text(self, text: str) -> str:
        """A whole text with odd tokens and spaced runs replaced by their readings."""
        low = _SPACED.sub(lambda m: restore(m.group().replace("\t", " "), self.model)
                          if len(set(m.group()) - {" ", "\t"}) > 2 else m.group(), text.lower())
        return re.sub(r"\S+", lambda m: " ".join(self.words(m.group())) if is_odd(trimmed(m.group())) else m.group(), low)


# --- lexicon and score ----------------------------------------------------------------------

def entries(word: str) -> list[str]:
    """Lexicon keys of a word: itself and its beginnings, marked with a tilde."""
    return [word, *[f"{word[:n]}~" for n in STEMS if len(word) > n]]


@dataclass
class Model:
    """Character model, lexicon of log-odds, and the weights of the document score."""

    chars: np.ndarray
    lexicon: dict[str, float]
    weights: list[float]
    squeezed: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.squeezed = {_RUN.sub(r"\1", k): k for k in self.lexicon if not k.endswith("~")}


def weight_of(word: str, lexicon: dict[str, float]) -> float:
    """The strongest entry of a word (0 without one)."""
    best = lexicon.get(word, 0.0)
    for n in STEMS:
        if len(word) > n:
            w = lexicon.get(f"{word[:n]}~", 0.0)
            if w > best:
                best = w
    return best


class Scorer:
    """Document evidence from distinct tokens, with a bounded memory of token weights."""

    def __init__(self, chars: np.ndarray, lexicon: dict[str, float], squeezed: dict[str, str]):
        self.restorer, self.lexicon, self.squeezed, self.memory = Restorer(chars), lexicon, squeezed, {}

    def token(self, token: str) -> float:
        best = 0.0
        for word in self.restorer.words(token):
            w = weight_of(word, self.lexicon)
            if not w and _RUN.search(word):
                # A doubled letter is worth a look only where the word without it is an entry.
                known = self.squeezed.get(_RUN.sub(r"\1", word))
                w = self.lexicon[known] if known and restore_as(word, known) else 0.0
            best = max(best, w)
        return best

    def evidence(self, text: str) -> tuple[float, float, float]:
        """Strongest weight, log of the summed weights, and of those per hundred distinct words."""
        low = text.lower()
        tokens = set(low.split())
        memory, found = self.memory, []
        if len(memory) > MEMORY:
            memory.clear()
        for t in tokens:
            w = memory.get(t)
            if w is None:
                w = memory[t] = self.token(t)
            if w:
                found.append(w)
        found += [w for w in (weight_of(x, self.lexicon) for x in set(self.restorer.spaced(low))) if w]
        total = math.fsum(found)
        return max(found, default=0.0), math.log1p(total), math.log1p(100.0 * total / max(len(tokens), 20))


def restore_as(word: str, known: str) -> bool:
    """Whether ``word`` is ``known`` with some letters repeated."""
    at = 0
    for c in known:
        if at >= len(word) or word[at] != c:
            return False
        at += 1
        while at < len(word) and word[at] == c and (at - 1 < 0 or word[at - 1] == c):
            at += 1
    return at == len(word)


def feature_counts(rows: DataFrame, chars: np.ndarray) -> DataFrame:
    """(fold, label, entry, n): documents per entry, from (text, label, fold); counted per task first."""
    shared = rows.sparkSession.sparkContext.broadcast(chars)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shared.value)
        held: dict[tuple[int, int], dict[str, int]] = {}
        for batch in batches:
            for t, label, fold in zip(*[c.to_pylist() for c in batch.columns]):
                low = (t or "").lower()
                words = {w for token in set(low.split()) for w in restorer.words(token)} | set(restorer.spaced(low))
                counts = held.setdefault((fold, label), {})
                for e in {e for w in words for e in entries(w)}:
                    counts[e] = counts.get(e, 0) + 1
        for (fold, label), counts in held.items():
            names = list(counts)
            for at in range(0, len(names), 50_000):
                part = names[at:at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), fold, np.int32)), pa.array(np.full(len(part), label, np.int32)), pa.array(part),
                     pa.array([counts[x] for x in part], pa.int64())], ["fold", "label", "entry", "n"])

    return map_arrow(rows.select("text", "label", "fold"), run, "fold int, label int, entry string, n bigint").groupBy(
        "fold", "label", "entry").agg(F.sum("n").alias("n"))


def lexicon_of(counts: DataFrame, folds: list[int], sizes: dict[tuple[int, int], int]) -> dict[str, float]:
    """Entries that mark label 1 beyond chance: a likelihood ratio above that of the best of as many random ones.

    Filtered by Spark; the driver gets all that pass, each from three or more documents of the bounded sample.
    """
    n1, n0 = (float(sum(sizes.get((f, y), 0) for f in folds)) for y in (1, 0))
    if not n1 or not n0:
        return {}
    wide = counts.where(F.col("fold").isin(folds)).groupBy("entry").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).cast("double").alias("a"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).cast("double").alias("b")).where("a >= 3")
    share = n1 / (n1 + n0)
    t = F.col("a") + F.col("b")
    g2 = 2 * (F.col("a") * F.log(F.col("a") / (t * share)) + F.when(F.col("b") > 0, F.col("b") * F.log(F.col("b") / (t * (1 - share)))).otherwise(0.0))
    odds = F.log((F.col("a") + 0.5) / (n1 + 1)) - F.log((F.col("b") + 0.5) / (n0 + 1))
    ranked = wide.select("entry", g2.alias("g2"), odds.alias("odds")).where("odds > 1").persist()
    tried = max(wide.count(), 10)
    rows = ranked.where(F.col("g2") > 2 * math.log(tried) + 6).collect()
    ranked.unpersist()
    return {r["entry"]: float(r["odds"]) for r in rows}


def evidence_of(rows: DataFrame, chars: np.ndarray, lexicon: dict[str, float], keep: list[str], text: str) -> DataFrame:
    """``keep`` columns and the evidence (e0, e1, e2) of whole texts."""
    source = rows.select(*[rows[f"`{c}`"] for c in keep], rows[f"`{text}`"].alias("_tox_text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]] + ["_e0 double", "_e1 double", "_e2 double"])
    shared = rows.sparkSession.sparkContext.broadcast(Model(chars, lexicon, []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        scorer = Scorer(m.chars, m.lexicon, m.squeezed)
        for batch in batches:
            got = [scorer.evidence(batch.column(len(keep))[i].as_py() or "") for i in range(batch.num_rows)]
            e = np.array(got, np.float64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], *[pa.array(e[:, i]) for i in range(3)]], [*keep, "_e0", "_e1", "_e2"])

    return map_arrow(source, run, schema)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weighted logistic regression by Newton steps; the intercept is not shrunk."""
    x = np.hstack([np.ones((len(x), 1)), x])
    beta = np.zeros(x.shape[1])
    shrink = ridge * np.eye(x.shape[1])
    shrink[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (weight * p * (1 - p))[:, None]) + shrink, x.T @ (weight * (y - p)) - shrink @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic",
          per_label: int = TRAIN_DOCS) -> Model:
    """A model from documents and labels; ``labels`` holds only rows that may be learned from.

    The character model covers all documents. The lexicon comes from about ``per_label``
    documents of each label (all, where fewer), each text once. The weights of the
    score are fitted on one half of them with the lexicon of the other half, so that chance
    entries do not look reliable. Without both labels every document gets the base rate.
    """
    chars = char_model(char_counts(docs, text))
    known = labels.select(F.col(f"`{key}`").alias("_k"), F.col(f"`{label}`").cast("int").alias("label")).where(
        "_k IS NOT NULL AND label IN (0, 1)").groupBy("_k").agg(F.max("label").alias("label"))
    counts = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    rate = F.lit(0.0)
    for y, n in counts.items():
        rate = F.when(F.col("label") == y, min(1.0, per_label / n)).otherwise(rate)
    part = F.pmod(F.xxhash64(F.lit("toxic"), F.col("_k")), F.lit(1 << 30))
    chosen = known.where(part / float(1 << 30) < rate).select("_k", "label", (part % 2).cast("int").alias("fold"))
    # The drawn keys are at most about 2 * per_label rows.
    rows = docs.select(F.col(f"`{key}`").alias("_k"), F.col(f"`{text}`").alias("text")).join(F.broadcast(chosen), "_k").where("text IS NOT NULL")
    rows = rows.groupBy("text").agg(F.min(F.struct("_k", "label", "fold")).alias("m")).select("text", "m.label", "m.fold").persist()
    sizes = {(r[0], r[1]): r[2] for r in rows.groupBy("fold", "label").count().collect()}
    per_entry = feature_counts(rows, chars).persist()
    half = lexicon_of(per_entry, [0], sizes)
    full = lexicon_of(per_entry, [0, 1], sizes)
    fit = evidence_of(rows.where("fold = 1"), chars, half, ["label"], "text").toPandas()
    per_entry.unpersist()
    rows.unpersist()
    y = fit["label"].to_numpy(np.float64)
    prior = {k: counts.get(k, 0) / max(sum(counts.values()), 1) for k in (0, 1)}
    if not len(y) or y.min() == y.max():
        base = min(max(prior[1], 1e-3), 1 - 1e-3) if counts else 1e-3
        return Model(chars, full, [math.log(base / (1 - base)), 0.0, 0.0, 0.0])
    w = np.where(y == 1, prior[1] / y.mean(), prior[0] / (1 - y.mean()))
    beta = logistic(fit[["_e0", "_e1", "_e2"]].to_numpy(np.float64), y, w)
    return Model(chars, full, [float(b) for b in beta])


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, threshold: float = 0.7) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` to every row; NULL and empty texts have no evidence.

    Texts are scored whole and row by row; ``keep`` lists the input columns to pass through.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted", "_e0", "_e1", "_e2")]
    seen = evidence_of(docs, model.chars, model.lexicon, kept, text)
    z = F.lit(model.weights[0])
    for i, b in enumerate(model.weights[1:]):
        z = z + F.col(f"_e{i}") * b
    return seen.withColumn("score", 1 / (1 + F.exp(-z))).withColumn("predicted", (F.col("score") >= threshold).cast("int")).drop("_e0", "_e1", "_e2")


def restored(docs: DataFrame, model: Model, text: str = "text", out: str = "restored") -> DataFrame:
    """Every row with its restored text (NULL stays NULL)."""
    kept = [c for c in docs.columns if c != out]
    source = docs.select(*[docs[f"`{c}`"] for c in kept], docs[f"`{text}`"].alias("_tox_text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]] + [f"`{out}` string"])
    shared = docs.sparkSession.sparkContext.broadcast(model.chars)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shared.value)
        for batch in batches:
            got = [None if t is None else restorer.text(t) for t in batch.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(got, pa.string())], [*kept, out])

    return map_arrow(source, run, schema)
