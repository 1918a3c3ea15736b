"""Fuzzy line dedup: MinHash over character shingles, exact confirmation, union of linked lines.

Lines are compared by their distinct texts (lower-cased, known by a 64-bit digest), so a line
that a third of all documents share is one candidate. Band keys go through one shuffle, sorted
by key; buckets are then read as runs, every line against the next ``WINDOW`` of its bucket and
the bucket's first, whatever the bucket's size. In larger buckets all pairs that these links leave
in different components are then compared in cells of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.llm.common import connected_components, cross_cells, hash_filter, joining, keep_possible, map_arrow
from demandcast.llm.shingles import distinct, mix
from demandcast.session import materialise

_U = np.uint64
#: Characters of a shingle, and of the shortest line that is compared at all; under a shingle's, lines link when they are equal.
WIDTH, SHORTEST = 8, 1
#: Characters of blank lines.
BLANK = " \t\x0b\x0c\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Bands of rows: at a similarity of 0.8 a pair shares no band with probability 0.005.
BANDS, ROWS = 10, 4
#: Following lines of a bucket that a line is compared with at once.
WINDOW = 16
#: Bits of the fixed-size filter for lines in question.
FILTER_BITS = 24
#: Characters handled at a time.
CHUNK = 1 << 18
#: Weight of a block of lines, each its characters and ``LINE_WEIGHT``; two blocks are held at a time.
BLOCK, LINE_WEIGHT = 1 << 18, 256
#: Shingles of a cell that are matched at a time.
COLUMNS = 4096

_rng = np.random.default_rng(31)
_ODD = _U(int(_rng.integers(0, 1 << 62)) * 2 + 1)
_VALUE = mix(np.arange(1 << 16, dtype=np.uint64) * _ODD + _U(1))
_PERM = _rng.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_STEP = _U(0xD1342543DE82EF95)
_BACK = _U(pow(0xD1342543DE82EF95, -1, 1 << 64))


def codes(texts: list[str]) -> np.ndarray:
    """Code points of lower-cased texts, joined by line ends."""
    # Text by text, as the ASCII ones among them are lower-cased several times faster; no rule of lower case looks past a line end.
    return np.frombuffer("\n".join([t.lower() for t in texts]).encode("utf-32-le", "surrogatepass"), np.uint32)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.cumprod(np.full(n, _STEP), dtype=np.uint64), np.cumprod(np.full(n + 1, _BACK), dtype=np.uint64)


def rolling(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial hash and what brings a difference of them to position 0."""
    n = len(chars)
    power, back = _powers(max(CHUNK + CHUNK // 4, 1 << (n - 1).bit_length() if n else 1))
    total = np.zeros(n + 1, _U)
    value = total[1:]
    _VALUE.take(chars, out=value, mode="clip")
    if n and chars.max() > 0xFFFF:
        far = np.flatnonzero(chars > 0xFFFF)
        value[far] = mix(chars[far].astype(_U) * _ODD + _U(1))
    value *= power[:n]
    np.cumsum(value, out=value)
    return total, back


def lines_of(chars: np.ndarray, sums: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and digests of the lines of an array of code points."""
    ends = np.concatenate([np.flatnonzero(chars == 10), [len(chars)]])
    starts = np.concatenate([[0], ends[:-1] + 1])
    total, back = sums or rolling(chars)
    digest = mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(_U) * _ODD)
    return starts, ends, digest.view(np.int64)


def shingles(sums: tuple[np.ndarray, np.ndarray], starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit shingle hashes of lines one after the other, and where each line's begin.

    Lines shorter than a shingle must have been left out.
    """
    total, back = sums
    counts = ends - starts - WIDTH + 1
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    at = np.repeat(starts - first, counts) + np.arange(counts.sum())
    every = total[WIDTH:] - total[:-WIDTH]
    every *= back[:len(every)]
    return mix(every[at]), first


def band_keys(sums: tuple[np.ndarray, np.ndarray], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(lines, BANDS): keys of each line's bands."""
    h, first = shingles(sums, starts, ends)
    h = (h >> _U(32)).astype(np.uint32)
    turned = np.empty_like(h)
    out = np.empty((len(starts), BANDS), np.int64)
    for b in range(BANDS):
        key = np.full(len(starts), b + 1, _U)
        for r in range(b * ROWS, (b + 1) * ROWS):
            np.multiply(h, _PERM[r], out=turned)
            key = mix(key * _STEP + np.minimum.reduceat(turned, first))
        out[:, b] = key.view(np.int64)
    return out


def _groups(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Runs of rows of bounded size with their texts; NULL counts as empty."""
    at, held, size = 0, [], 0
    for i, t in enumerate(column.to_pylist()):
        t = t or ""
        if held and size + len(t) > CHUNK:
            yield at, held
            at, held, size = i, [], 0
        held.append(t)
        size += len(t) + 1
    if held:
        yield at, held


_BLANK = np.zeros(0x3002, bool)
_BLANK[[i for i in range(0x3001) if re.match(f"[{BLANK}]", chr(i))]] = True


def comparable(chars: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int = SHORTEST) -> np.ndarray:
    """Whether lines have ``least`` characters or more and one that is not blank."""
    fine = (ends - starts >= least) & (ends > starts)
    # Few lines begin with a blank: only those are read on.
    at = np.flatnonzero(fine)
    at = at[_BLANK[np.minimum(chars[starts[at]], 0x3001)]]
    if len(at):
        counts = ends[at] - starts[at]
        first = np.cumsum(counts) - counts
        place = np.repeat(starts[at] - first, counts) + np.arange(counts.sum())
        fine[at] = ~np.logical_and.reduceat(_BLANK[np.minimum(chars[place], 0x3001)], first)
    return fine


def line_table(docs: DataFrame, text: str, key: str) -> DataFrame:
    """(id, line_no, digest, keys): every line; a NULL digest marks blank lines.

    ``keys`` are the band keys of a line of a shingle or more that is not blank, empty where the task
    remembers that it gave them before.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for at, texts in _groups(batch.column(1)):
                chars = codes(texts)
                sums = rolling(chars)
                starts, ends, digest = lines_of(chars, sums)
                counts = np.array([t.count("\n") + 1 for t in texts])
                ids = np.repeat(np.arange(len(texts)), counts)
                number = np.arange(len(ids)) - np.repeat(np.cumsum(counts) - counts, counts)
                known = comparable(chars, starts, ends)
                fine = np.flatnonzero(known & (ends - starts >= WIDTH))
                fine = fine[np.unique(digest[fine], return_index=True)[1]]
                fine.sort()
                if len(seen) > 500_000:
                    seen.clear()
                fine = fine[[x not in seen for x in digest[fine].tolist()]] if len(fine) else fine
                seen.update(digest[fine].tolist())
                sizes = np.zeros(len(ids) + 1, np.int32)
                sizes[fine + 1] = BANDS
                keys = band_keys(sums, starts[fine], ends[fine]).reshape(-1) if len(fine) else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)).take(pa.array(ids)), pa.array(number.astype(np.int32)),
                     pa.array(digest, mask=~known), pa.ListArray.from_arrays(np.cumsum(sizes, dtype=np.int32), pa.array(keys))],
                    ["id", "line_no", "digest", "keys"])

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("t"))
    return map_arrow(rows, run, "id bigint, line_no int, digest bigint, keys array<bigint>")


def _candidates(rows: DataFrame) -> DataFrame:
    """(a, b, k): pairs within buckets; rows with a NULL ``b`` list members of buckets over the window, each once.

    Reads rows sorted by (k, digest) as a stream, repeated rows once; a bucket is never held.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail_k, tail_d = np.empty(0, np.int64), np.empty(0, np.int64)
        lead_k, lead_d, lead_n = None, None, 0  # of the bucket that is open at the end of a batch
        for batch in batches:
            k, d = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if len(k):
                again = (k[1:] == k[:-1]) & (d[1:] == d[:-1])
                once = ~np.concatenate([[len(tail_k) > 0 and k[0] == tail_k[-1] and d[0] == tail_d[-1]], again])
                k, d = k[once], d[once]
            if not len(k):
                continue
            new = np.concatenate([[lead_k is None or k[0] != lead_k], k[1:] != k[:-1]])
            begin = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            head_d = np.where(group >= 0, d[begin[np.maximum(group, 0)]] if len(begin) else 0, lead_d if lead_d is not None else 0)
            place = np.arange(len(k)) - (begin[np.maximum(group, 0)] if len(begin) else 0)
            place = np.where(group >= 0, place, np.arange(len(k)) + lead_n)
            all_k, all_d = np.concatenate([tail_k, k]), np.concatenate([tail_d, d])
            out = []
            for step in range(1, WINDOW + 1):
                same = np.flatnonzero((all_k[step:] == all_k[:-step]) & (np.arange(step, len(all_k)) >= len(tail_k)))
                out.append((all_d[same], all_d[same + step]))
            far = np.flatnonzero(place > WINDOW)
            out.append((head_d[far], d[far]))
            a, b = (np.concatenate(x) for x in zip(*out))
            keep = a != b
            a, b = a[keep], b[keep]
            # A bucket's first row past the window brings the rows before it; every later one comes by itself.
            past = np.flatnonzero(place == WINDOW + 1) + len(tail_k)
            member = np.concatenate([(past[:, None] - np.arange(1, WINDOW + 2)).reshape(-1), far + len(tail_k)]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.minimum(a, b), all_d[member]])),
                 pa.array(np.concatenate([np.maximum(a, b), np.zeros(len(member), np.int64)]),
                          mask=np.concatenate([np.zeros(len(a), bool), np.ones(len(member), bool)])),
                 pa.array(np.concatenate([np.zeros(len(a), np.int64), all_k[member]]),
                          mask=np.concatenate([np.ones(len(a), bool), np.zeros(len(member), bool)]))], ["a", "b", "k"])
            if len(begin):
                lead_k, lead_d, lead_n = k[-1], d[begin[-1]], len(k) - begin[-1]
            else:
                lead_n += len(k)
            tail_k, tail_d = all_k[-WINDOW - 1:], all_d[-WINDOW - 1:]

    sorted_rows = rows.select("k", "digest").repartition("k").sortWithinPartitions("k", "digest")
    return map_arrow(sorted_rows, run, "a bigint, b bigint, k bigint")


def _wanted_bits(pairs: DataFrame) -> np.ndarray:
    """Bitmap of hashed digests in question: 2^FILTER_BITS bits at most reach the driver."""
    slot = F.expr(f"(a_ >> 20) & {(1 << FILTER_BITS) - 1}")
    words = pairs.select(F.explode(F.array("a", "b")).alias("a_")).select(slot.alias("s")).groupBy(F.expr("s >> 6").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(s & 63 AS INT))")).alias("b")).toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    bits[words["w"].to_numpy()] = words["b"].to_numpy()
    return bits.view(_U)


def _texts(docs: DataFrame, text: str, pairs: DataFrame) -> DataFrame:
    """(digest, line): text of each line that may be in question, once."""
    shared = docs.sparkSession.sparkContext.broadcast(_wanted_bits(pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = shared.value, set()
        for batch in batches:
            for _, texts in _groups(batch.column(0)):
                chars = codes(texts)
                starts, ends, digest = lines_of(chars)
                slot = (digest >> 20) & ((1 << FILTER_BITS) - 1)
                hit = np.flatnonzero((bits[slot >> 6] >> (slot & 63).astype(_U) & _U(1)).astype(bool) & (ends - starts >= WIDTH))
                new = [i for i in hit.tolist() if digest[i] not in seen]
                if len(seen) > 500_000:
                    seen.clear()
                seen.update(digest[new].tolist())
                if new:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(digest[new]), pa.array([chars[starts[i]:ends[i]].tobytes().decode("utf-32-le", "surrogatepass") for i in new])],
                        ["digest", "line"])

    found = map_arrow(docs.select(F.col(f"`{text}`").alias("t")).where("t IS NOT NULL"), run, "digest bigint, line string")
    return found.groupBy("digest").agg(F.min("line").alias("line"))


def jaccards(left: list[str], right: list[str]) -> np.ndarray:
    """Jaccard similarity of the shingle sets of pairs of lines, fewer than 2^19 at a time.

    Pair number, 44 hash bits and the side make one integer, so that one sort brings repeats of a side and what both share together.
    """
    n = len(left)
    lines = left + right
    ends = np.cumsum([len(x) + 1 for x in lines]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    h, first = shingles(rolling(codes(lines)), starts, ends)
    label = np.tile(np.arange(n, dtype=_U) << _U(45), 2)
    label[n:] |= _U(1)
    h >>= _U(20)
    h <<= _U(1)
    h |= np.repeat(label, np.diff(np.concatenate([first, [len(h)]])))
    items = distinct(h)
    pair = (items >> _U(45)).astype(np.int64)
    common = np.bincount(pair[1:][(items[1:] ^ items[:-1]) == _U(1)], minlength=n)
    return common / np.maximum(np.bincount(pair, minlength=n) - common, 1)


def _confirmed(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = (batch.column(i) for i in range(4))
            left, right = x.to_pylist(), y.to_pylist()
            at = 0
            while at < len(left):
                end, size = at, 0
                while end < len(left) and (end == at or size < CHUNK):
                    size += len(left[end]) + len(right[end])
                    end += 1
                fine = pa.array(np.flatnonzero(jaccards(left[at:end], right[at:end]) >= similarity - 1e-12) + at)
                yield pa.RecordBatch.from_arrays([a.take(fine), b.take(fine)], ["a", "b"])
                at = end

    lengths = (F.length("x") - WIDTH + 1 >= 1) & (F.length("y") - WIDTH + 1 >= 1)
    joined = pairs.join(texts.select(F.col("digest").alias("a"), F.col("line").alias("x")), "a").join(
        texts.select(F.col("digest").alias("b"), F.col("line").alias("y")), "b").where(lengths).select("a", "b", "x", "y")
    return map_arrow(joined, run, "a bigint, b bigint")


def _sets(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (line, shingle) of lines: numbers of lines, and shingle hashes."""
    chars = codes(lines)
    ends = np.cumsum([len(x) + 1 for x in lines]) - 1
    h, first = shingles(rolling(chars), np.concatenate([[0], ends[:-1] + 1]), ends)
    line = np.repeat(np.arange(len(lines)), np.diff(np.concatenate([first, [len(h)]])))
    order = np.lexsort((h, line))
    h, line = h[order], line[order]
    once = np.concatenate([[True], (h[1:] != h[:-1]) | (line[1:] != line[:-1])])
    return line[once], h[once]


def _similar(left: list[str], right: list[str], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs, one of each side, at ``similarity`` or more."""
    (x, g), (y, h) = _sets(left), _sets(right)
    size = np.bincount(x, minlength=len(left))[:, None] + np.bincount(y, minlength=len(right))[None, :]
    known = np.intersect1d(g, h)
    mine, theirs = np.isin(g, known), np.isin(h, known)
    x, g, y, h = x[mine], np.searchsorted(known, g[mine]), y[theirs], np.searchsorted(known, h[theirs])
    common = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(known), COLUMNS):
        one, two = (g >= at) & (g < at + COLUMNS), (h >= at) & (h < at + COLUMNS)
        a, b = np.zeros((len(left), COLUMNS), np.float32), np.zeros((len(right), COLUMNS), np.float32)
        a[x[one], g[one] - at] = 1
        b[y[two], h[two] - at] = 1
        common += a @ b.T
    return np.nonzero(common / (size - common) >= similarity - 1e-12)


def _links_across(crowd: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(a, b): links between members of a bucket in different components, as many as join them.

    ``crowd`` has (k, digest, c), the component last. Every such pair is compared on its shingle sets; of several
    links of a cell that join the same components one is returned.
    """
    known = crowd.join(texts, "digest").where(F.length("line") >= WIDTH)
    cells = cross_cells(known.select("k", F.col("digest").alias("id"), "c", (F.length("line") + LINE_WEIGHT).alias("w")), BLOCK)

    def of(rows: list[tuple]) -> tuple[list[int], list[int]]:
        i, j = rows[0][1:3]
        one = [r for r in rows if r[3] == i]
        two = one if i == j else [r for r in rows if r[3] == j]
        if not one or not two:
            return [], []
        x, y = _similar([r[6] for r in one], [r[6] for r in two], similarity)
        p, q = np.array([r[5] for r in one], np.int64)[x], np.array([r[5] for r in two], np.int64)[y]
        x, y, p, q = (v[p != q] for v in (x, y, p, q))
        fine = joining(p.tolist(), q.tolist())
        return [one[v][4] for v in x[fine]], [two[v][4] for v in y[fine]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if row[:3] != at:
                    if held:
                        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in of(held)], ["a", "b"])
                    at, held = row[:3], []
                held.append(row)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in of(held)], ["a", "b"])

    rows = cells.join(texts.withColumnRenamed("digest", "id"), "id").select("k", "i", "j", "side", "id", "c", "line")
    return map_arrow(rows.repartition("k", "i", "j").sortWithinPartitions("k", "i", "j"), run, "a bigint, b bigint").distinct()


def linked_lines(lines: DataFrame, docs: DataFrame, text: str = "text", similarity: float = 0.8) -> DataFrame:
    """(digest, component) of the distinct lines that are linked with another one; ``lines`` is the line table of ``docs``."""
    found = materialise(_candidates(lines.select(F.explode("keys").alias("k"), "digest")))
    pairs = materialise(found.where("b IS NOT NULL").select("a", "b").distinct())
    texts = materialise(_texts(docs, text, pairs))
    links = materialise(_confirmed(pairs, texts, similarity))
    groups = materialise(connected_components(links.select(F.col("a").alias("src"), F.col("b").alias("dst"))))

    # Members of buckets over the window, of those buckets only that the links leave in several components.
    member = found.where("b IS NULL").select("k", F.col("a").alias("digest"))
    if member.isEmpty():
        return groups.withColumnRenamed("node", "digest")
    known = materialise(member.join(groups.withColumnRenamed("node", "digest"), "digest", "left").select("k", "digest", F.coalesce("component", "digest").alias("c")))
    apart = known.groupBy("k").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("k")
    crowd = known.join(apart, "k", "left_semi")
    new = materialise(_links_across(crowd, texts, similarity))
    if new.isEmpty():
        return groups.withColumnRenamed("node", "digest")
    # The new links join components: the old ones are single nodes of what is left to connect.
    of = groups.withColumnRenamed("component", "_c")
    ends = new.join(of.select(F.col("node").alias("a"), F.col("_c").alias("x")), "a", "left").join(
        of.select(F.col("node").alias("b"), F.col("_c").alias("y")), "b", "left").select(F.coalesce("x", "a").alias("src"), F.coalesce("y", "b").alias("dst"))
    upper = materialise(connected_components(ends)).select(F.col("node").alias("_c"), F.col("component").alias("_top"))
    moved = of.join(upper, "_c", "left").select("node", F.coalesce("_top", "_c").alias("component"))
    # Lines that only the new links reach are their own component so far.
    fresh = upper.join(of.select(F.col("node").alias("_c")), "_c", "left_anti").select(F.col("_c").alias("node"), F.col("_top").alias("component"))
    return moved.unionByName(fresh).withColumnRenamed("node", "digest")


def line_components(docs: DataFrame, text: str = "text", key: str = "doc_id", similarity: float = 0.8) -> DataFrame:
    """(key, line_no, first_doc, first_line, kept): one row per line of every document.

    Lines end at newline characters; a NULL or empty text has one empty line. Lines of at least
    ``WIDTH`` characters are linked when their shingle sets have a Jaccard similarity of
    ``similarity`` or more, upper and lower case alike; ``first_doc`` and ``first_line`` name
    the first line (by key, then number) of the component and ``kept`` marks it. Shorter lines
    are linked when they are equal. Blank lines are never compared and always kept. Lines of a NULL key come after all others.
    """
    lines = materialise(line_table(docs, text, key))
    groups = linked_lines(lines, docs, text, similarity)
    place = F.struct(F.col("id").isNull().alias("last"), "id", "line_no")
    per_line = lines.where("digest IS NOT NULL").groupBy("digest").agg(F.min(place).alias("p"), F.count(F.lit(1)).alias("n"))
    placed = per_line.join(groups, "digest", "left")
    # A line seen once and linked with nothing is its own first line: only the others are joined back.
    # They are written, as two joins read them: every line would be aggregated for each.
    first = materialise(placed.where("n > 1 OR component IS NOT NULL"))
    top = first.where("component IS NOT NULL").groupBy("component").agg(F.min("p").alias("top"))
    firsts = materialise(first.join(top, "component", "left").select("digest", F.coalesce("top", "p").alias("f")))
    joined = lines.join(firsts, "digest", "left")
    return joined.select(
        F.col("id").alias(key), "line_no", F.when(F.col("f").isNull(), F.col("id")).otherwise(F.col("f.id")).alias("first_doc"),
        F.coalesce("f.line_no", "line_no").alias("first_line")).withColumn(
        "kept", F.col(key).eqNullSafe(F.col("first_doc")) & (F.col("line_no") == F.col("first_line")))


def dedup_documents(docs: DataFrame, text: str = "text", key: str = "doc_id", similarity: float = 0.8) -> DataFrame:
    """Documents without the lines that repeat an earlier one.

    All columns are returned. A document that loses lines and has only blank ones or none left is
    dropped; documents that lose nothing are untouched, NULL and empty texts among them. Only numbers of lost lines are joined to the documents.
    """
    lines = line_components(docs, text, key, similarity)
    lost = materialise(lines.where(f"NOT kept AND `{key}` IS NOT NULL").groupBy(key).agg(
        F.collect_set("line_no").alias("_lost")).withColumnRenamed(key, "_key"))
    flt = hash_filter(lost, "_key")
    maybe = keep_possible(docs, key, flt)
    joined = maybe.join(lost, maybe[f"`{key}`"] == lost["_key"], "left")
    parts = F.split(F.col(f"`{text}`"), "\n", -1)
    done = joined.withColumn("_left", F.when(F.col("_lost").isNotNull(), F.filter(parts, lambda x, i: ~F.array_contains("_lost", i))))
    out = F.when(F.col("_lost").isNull(), F.col(f"`{text}`")).otherwise(F.array_join("_left", "\n"))
    fine = F.col("_lost").isNull() | F.exists("_left", lambda x: x.rlike(f"[^{BLANK}]"))
    changed = done.where(fine).select(*[out.alias(c) if c == text else maybe[f"`{c}`"] for c in docs.columns])
    return keep_possible(docs, key, flt, others=True).unionByName(changed)
