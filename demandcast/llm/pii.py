"""Personal data by weak supervision, in DataFrame functions only.

Base patterns find e-mail addresses, IP addresses, card and phone numbers. Wider patterns propose
more spans; regex, gazetteer and context labelers vote on every span. Expectation-maximisation
over the vote patterns estimates how reliable each labeler is, and a logistic span classifier is
trained on the posteriors. Base spans always stay; a proposed span is added where the classifier
says so and no base span overlaps it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandcast.session import materialise

#: Kinds in the order of results; the first four are the base.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "masked_email", "local_phone", "secret", "national_id")

#: Patterns of the base. They match what the plain ones do, but possessive loops and the look-behinds keep
#: them linear on long runs: a run of its own characters is entered at its start or where the last match ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "masked_email": r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\s{0,2}(?:\[at\]|\(at\)|\sat\s)\s{0,2}[A-Za-z0-9-]{1,63}+"
                    r"(?:\s{0,2}(?:\[dot\]|\(dot\)|\sdot\s)\s{0,2}[A-Za-z0-9-]{1,63}+){1,5}+",
    "local_phone": r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
    "secret": r"(?i)\b(?:api[_-]?key|access[_-]?key|token|secret|password|passwd)\b[\"']?\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9+/_=-]{8,512}+",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}

#: Gazetteers: top-level names of mail hosts and leading digits of card issuers.
MAIL_ENDINGS = "com|org|net|edu|gov|info|io|de|fr|es|uk|eu|it|ch|at|nl|be|us|ca"
CARD_STARTS = "^(?:4|5[1-5]|2[2-7]|3[47]|6)"
#: Words near a span that speak for it, and against any.
CONTEXT = {
    "email": "mail|contact|write|kontakt|correo|courriel", "ip": r"\bip\b|server|host|address|adresse|client|login",
    "card": "card|karte|tarjeta|carte|visa|credit|payment", "phone": "phone|tel|call|fax|mobile|anruf|llam",
    "masked_email": "mail|contact|write|kontakt|correo|courriel", "local_phone": "phone|tel|call|fax|mobile|anruf|llam",
    "secret": "key|token|secret|password|config|export|env", "national_id": "ssn|social|security|identity|ausweis|dni",
}
AGAINST = r"version|isbn|issue|page|section|figure|chapter|example\s*$|\bv\s*$|#\s*$"

LABELERS = ("pattern", "gazetteer", "context", "shape")
BEFORE = 40
ROUNDS = 50
#: Matches of a text that are listed together.
SPANS_AT = 128


def raw_spans(text: Column, kind: str) -> Column:
    """array<struct<kind, start, end, hit, before>> of the leftmost non-overlapping matches, in code points."""
    pattern = PATTERNS[kind]
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    empty = F.array().cast("array<struct<kind:int,start:int,end:int,hit:string,before:string>>")

    def walk(s: Column) -> Column:
        def add(state: Column, i: Column) -> Column:
            start = state["at"] + F.length(s["p"][i])
            end = start + F.length(s["h"][i])
            span = F.struct(F.lit(KINDS.index(kind)).alias("kind"), start.alias("start"), end.alias("end"), s["h"][i].alias("hit"),
                            F.right(s["p"][i], F.lit(BEFORE)).alias("before"))
            return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

        # Matches in blocks: only a block's own list is copied for each of its matches, and a block starts where the sums of
        # the blocks before it end.
        n = F.size(s["h"])
        blocks = F.sequence(F.lit(0), F.floor((n - 1) / SPANS_AT).cast("int"))

        def inside(b: Column) -> Column:
            return F.sequence(b * SPANS_AT, F.least((b + 1) * SPANS_AT, n) - 1)

        sums = F.transform(blocks, lambda b: F.aggregate(inside(b), F.lit(0), lambda t, i: t + F.length(s["p"][i]) + F.length(s["h"][i])))
        begins = F.aggregate(sums, F.array(F.lit(0)), lambda t, x: F.concat(t, F.array(F.element_at(t, -1) + x)))
        # One element again, so that the beginnings are found once.
        return F.flatten(F.transform(F.array(begins), lambda at: F.flatten(F.transform(blocks, lambda b: F.aggregate(
            inside(b), F.struct(at[b].alias("at"), empty.alias("out")), add)["out"]))))

    # The one-element array binds both lists once for all steps.
    both = F.array(F.struct(pieces.alias("p"), hits.alias("h")))
    return F.when(text.rlike(pattern), F.transform(both, walk)[0]).otherwise(empty)


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    turned = F.reverse(number)

    def value(i: Column) -> Column:
        d = F.substr(turned, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), lambda s, i: s + value(i)) % 10 == 0


def base_passes(span: Column) -> Column:
    """The base's own checks; matches that fail are dropped, nothing is tried again."""
    n = F.length(digits(span["hit"]))
    kind = span["kind"]
    return (kind == 0) | ((kind == 1) & F.forall(F.split(span["hit"], r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike(
        "^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))) | ((kind == 2) & n.between(14, 19) & luhn(digits(span["hit"]))) | (
        (kind == 3) & n.between(10, 15))


def votes(span: Column) -> list[Column]:
    """Votes of the labelers on a span, in the order of LABELERS: 1 for, -1 against, 0 silent."""
    hit, before, kind = span["hit"], F.lower(span["before"]), span["kind"]
    low = F.lower(hit)
    n = F.length(digits(hit))
    pattern = F.when(kind < len(BASE), F.when(base_passes(span), 1).otherwise(-1)).when(
        kind == KINDS.index("local_phone"), F.when(low.rlike(r"^\([0-9]{3}\)"), 1).otherwise(0)).when(
        kind == KINDS.index("masked_email"), F.when(low.rlike(r"[\[(](?:at|dot)[\])]"), 1).otherwise(0)).otherwise(1)
    gazetteer = F.when(kind.isin(0, 4), F.when(low.rlike(rf"(?:{MAIL_ENDINGS})$"), 1).otherwise(-1)).when(
        kind == 2, F.when(digits(hit).rlike(CARD_STARTS), 1).otherwise(-1)).when(
        kind == KINDS.index("national_id"), F.when(low.rlike("^(?:000|666|9)|-00-|-0000$"), -1).otherwise(1)).otherwise(0)
    near = F.lit(None).cast("boolean")
    for name, ask in CONTEXT.items():
        near = F.when(kind == KINDS.index(name), before.rlike(ask)).otherwise(near)
    context = F.when(before.rlike(AGAINST), -1).when(near, 1).otherwise(0)
    same = F.length(F.replace(digits(hit), F.substr(digits(hit), F.lit(1), F.lit(1)), F.lit(""))) == 0
    value = F.regexp_extract(hit, r"[=:]\s{0,3}[\"']?([^\"']+)$", 1)
    shape = F.when(kind == KINDS.index("secret"), F.when(value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.length(value) >= 16), 1).otherwise(-1)).when(
        (n > 3) & same, -1).when(kind.isin(3, 5) & n.isin(10, 11), 1).otherwise(0)
    return [pattern, gazetteer, context, shape]


def span_table(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` and ``_spans``: every match of every pattern with its votes, for whole texts."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    found = docs.select(*[F.col(f"`{c}`") for c in keep], F.concat(*[raw_spans(t, k) for k in KINDS]).alias("_s"))

    def voted(s: Column) -> Column:
        v = votes(s)
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                        base_passes(s).alias("base"),
                        F.array(*[x.cast("int") for x in v]).alias("votes"), F.length(s["hit"]).alias("size"))

    return found.select(*[F.col(f"`{c}`") for c in keep], F.transform("_s", voted).alias("_spans"))


# --- reliabilities and classifier: over vote patterns, at most kinds * 3^labelers rows ----------

def estimate(patterns: list[tuple[int, tuple[int, ...], float]], rounds: int = ROUNDS) -> tuple[dict, list[dict]]:
    """EM over (kind, votes, count): the share of true spans per kind, and each labeler's vote rates.

    A labeler is described by P(vote | true) and P(vote | false) over its three votes. It starts
    as one that is right four times in five, which fixes which class is which.
    """
    kinds = sorted({k for k, _, _ in patterns})
    share = {k: 0.5 for k in kinds}
    m = len(LABELERS)
    rates = [{1: {1: 0.6, 0: 0.25, -1: 0.15}, 0: {1: 0.15, 0: 0.25, -1: 0.6}} for _ in range(m)]
    for _ in range(rounds):
        got = {k: [1.0, 1.0] for k in kinds}
        tally = [{y: {1: 0.5 + 2.0 * (y == 1), 0: 0.5, -1: 0.5 + 2.0 * (y == 0)} for y in (0, 1)} for _ in range(m)]
        for kind, vote, n in patterns:
            p = posterior(kind, vote, share, rates)
            got[kind][1] += n * p
            got[kind][0] += n * (1 - p)
            for j, v in enumerate(vote):
                tally[j][1][v] += n * p
                tally[j][0][v] += n * (1 - p)
        share = {k: b / (a + b) for k, (a, b) in got.items()}
        rates = [{y: {v: c / sum(t[y].values()) for v, c in t[y].items()} for y in (0, 1)} for t in tally]
    return share, rates


def posterior(kind: int, vote: tuple[int, ...], share: dict, rates: list[dict]) -> float:
    z = math.log(share[kind] / (1 - share[kind]))
    for j, v in enumerate(vote):
        z += math.log(rates[j][1][v] / rates[j][0][v])
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def features(kind: int, vote: tuple[int, ...]) -> list[float]:
    """Intercept, one column per kind, and for every labeler one for each non-silent vote."""
    return [1.0, *[float(kind == k) for k in range(len(KINDS))], *[x for v in vote for x in (float(v == 1), float(v == -1))]]


def train_classifier(patterns: list[tuple[int, tuple[int, ...], float]], share: dict, rates: list[dict], steps: int = 300) -> list[float]:
    """Logistic regression on posteriors, weighted by counts, by gradient steps with a fixed curvature bound."""
    rows = [(features(k, v), posterior(k, v, share, rates), n) for k, v, n in patterns]
    total = sum(n for _, _, n in rows)
    beta = [0.0] * (1 + len(KINDS) + 2 * len(LABELERS))
    if not total:
        return beta
    # No row has more than 2 + labelers ones, which bounds the curvature.
    rate = 4.0 / (2 + len(LABELERS))
    for _ in range(steps):
        slope = [-1e-4 * b for b in beta]
        for x, y, n in rows:
            p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(x, beta))))
            for i, a in enumerate(x):
                if a:
                    slope[i] += n / total * (y - p)
        beta = [b + rate * s for b, s in zip(beta, slope)]
    return beta


def probability(span: Column, beta: list[float]) -> Column:
    """The classifier's probability of a voted span as an expression."""
    z = F.lit(beta[0])
    for k in range(len(KINDS)):
        z = z + F.when(span["kind"] == k, beta[1 + k]).otherwise(0.0)
    for j in range(len(LABELERS)):
        at = 1 + len(KINDS) + 2 * j
        z = z + F.when(span["votes"][j] == 1, beta[at]).when(span["votes"][j] == -1, beta[at + 1]).otherwise(0.0)
    return 1 / (1 + F.exp(-z))


def find(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all but the text), ``base_spans`` and ``all_spans``.

    Both are arrays of (start, kind, end), kind by its place in ``KINDS``, sorted; positions count
    code points, the end is exclusive. NULL and empty texts have none. Rows are judged by
    themselves; only counts of vote patterns, a few hundred rows at most, are gathered. Matches
    are written once and serve both the training and the result.
    """
    kept = [c for c in docs.columns if c != text] if keep is None else keep
    table = materialise(span_table(docs, text, kept))
    counted = table.select(F.explode("_spans").alias("s")).groupBy("s.kind", "s.votes").agg(F.count(F.lit(1)).alias("n"))
    patterns = sorted((r["kind"], tuple(r["votes"]), float(r["n"])) for r in counted.collect())
    share, rates = estimate(patterns)
    beta = train_classifier(patterns, share, rates)

    spans = F.col("_spans")
    base = F.filter(spans, lambda s: s["base"])
    short = lambda xs: F.transform(xs, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    wide = F.filter(spans, lambda s: (s["kind"] >= len(BASE)) & (probability(s, beta) >= 0.5))
    split = table.select(*[F.col(f"`{c}`") for c in kept], F.array_sort(short(base)).alias("base_spans"), short(wide).alias("_wide"))
    free = F.filter("_wide", lambda w: ~F.exists("base_spans", lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))
    return split.withColumn("all_spans", F.array_sort(F.concat("base_spans", free))).drop("_wide")


def shown(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def summary(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every row."""
    found = find(docs, text, [key])

    def count(kind: int) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{BASE[kind]}")

    return found.select(F.col(f"`{key}`"), *[count(i) for i in range(len(BASE))], F.sha2(shown(F.col("base_spans")), 256).alias("base_sha256"), shown(F.col("all_spans")).alias("spans"))
