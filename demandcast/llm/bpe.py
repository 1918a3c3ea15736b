"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

A text is cut before encoding at places where the split pattern always starts a new piece, so
no piece, and therefore no token, changes: a very long text is encoded in bounded parts by a
library whose regex engine would otherwise hold it whole. Ids decode to raw bytes, which are
joined before any UTF-8 decoding.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from demandcast.llm.common import map_arrow

#: Splits text before merges are applied; a fixed value that ids depend on.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Texts over this many characters are cut at safe boundaries.
PART_CHARS = 65_536

#: Texts of one call to the library and rows of one reply hold about this many characters.
BATCH_CHARS = 2_000_000

# An ASCII letter, digit or full stop/comma before a single space before an ASCII letter: the piece before the space
# ends there whatever precedes it, and the space opens the next piece.
_SAFE = re.compile(r"(?<=[A-Za-z0-9.,]) (?=[A-Za-z])")


#: White space of the split pattern: the Unicode property, which leaves out the separators 1C to 1F.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Runs of white space from this length on never reach the library's regex engine, whose stack they would exhaust.
LONG_RUN = 1_000
_RUN = re.compile(f"[{WHITE}]{{{LONG_RUN},}}")


def cut_points(text: str, size: int = PART_CHARS) -> list[int]:
    """Ends of the parts: the first safe boundary at or after every ``size`` characters."""
    ends, at = [], 0
    while len(text) - at > size:
        m = _SAFE.search(text, at + size)
        if m is None:
            break
        at = m.start()
        ends.append(at)
    return [*ends, len(text)]


def parts(text: str, size: int = PART_CHARS) -> list[str]:
    at, out = 0, []
    for end in cut_points(text, size):
        out.append(text[at:end])
        at = end
    return out


@lru_cache(maxsize=4)
def encoder(ranks: bytes, pattern: str):
    """The tokenizer of a rank file's bytes, made once per Python worker."""
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def stretches(text: str) -> Iterator[tuple[str, bool]]:
    """(part, whole piece?) in order: long runs of white space, and what lies between them.

    The pattern opens a piece where white space begins. It makes one piece of a run but for its last
    character if something follows, which the next piece may take along.
    """
    at = 0
    for m in _RUN.finditer(text):
        if m.start() > at:
            yield text[at:m.start()], False
        at = m.end() - (m.end() < len(text))
        yield text[m.start():at], True
    if at < len(text):
        yield text[at:], False


def encode_text(enc, text: str, size: int = PART_CHARS) -> np.ndarray:
    """Ids of a whole text as little-endian unsigned 32-bit integers, whatever its length and content."""
    if len(text) <= size:
        return np.array(enc.encode_ordinary(text), dtype="<u4")
    found = [np.empty(0, "<u4")]
    for part, whole in stretches(text):
        found += [np.array(x, dtype="<u4") for x in ([enc._encode_single_piece(part.encode())] if whole else map(enc.encode_ordinary, parts(part, size)))]
    return np.concatenate(found)


def decode_ids(enc, ids: np.ndarray) -> bytes:
    """Raw bytes of ids; not necessarily valid UTF-8 when ids were cut."""
    return enc.decode_bytes(ids.tolist())


def _ranks_reader(spark, path: str):
    """The rank file's content on every executor: its bytes travel as a broadcast.

    A rank file has one line per id of a fixed vocabulary (under a megabyte here), so its size
    does not depend on the corpus.
    """
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(df: DataFrame, path: str, text: str = "text", pattern: str = PATTERN, ids: str | None = None,
           n_tokens: str = "n_tokens", ids_sha: str | None = None, decoded: str | None = None,
           decoded_sha: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Encode every whole ``text`` and, where asked for, decode the ids again.

    ``ids`` names an array<int> column for the ids, ``decoded`` a binary column for the decoded
    bytes, ``ids_sha`` and ``decoded_sha`` columns for hex digests; those that are None are not
    made. NULL text counts as empty: no ids, the digest of no bytes. ``keep`` lists input columns
    to pass through (default: all but the text is kept when the names do not clash; a new
    column replaces an old one of its name). Rows are independent: nothing is shuffled.
    """
    kept = [c for c in (df.columns if keep is None else keep) if c not in (n_tokens, ids, ids_sha, decoded, decoded_sha)]
    made = {n_tokens: pa.int64(), ids: pa.list_(pa.int32()), ids_sha: pa.string(), decoded: pa.binary(),
            decoded_sha: pa.string()}
    made = {k: v for k, v in made.items() if k}
    source = df.select(*[df[f"`{c}`"] for c in kept], df[f"`{text}`"].alias("_bpe_text"))
    names = {pa.int64(): "bigint", pa.list_(pa.int32()): "array<int>", pa.string(): "string", pa.binary(): "binary"}
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
    schema = ", ".join(fields + [f"`{k}` {names[v]}" for k, v in made.items()])
    shared = _ranks_reader(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value, pattern)
        for batch in batches:
            lengths = np.cumsum(pc.utf8_length(batch.column(batch.num_columns - 1).fill_null("")).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                floor = lengths[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(lengths, floor + BATCH_CHARS)))
                yield reply(enc, batch.slice(at, end - at))
                at = end

    def reply(enc, batch: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list] = {k: [] for k in made}
        for t in batch.column(batch.num_columns - 1).to_pylist():
            got = encode_text(enc, t or "")
            out[n_tokens].append(len(got))
            if ids:
                out[ids].append(got.astype(np.int32))
            if ids_sha:
                out[ids_sha].append(hashlib.sha256(got.tobytes()).hexdigest())
            if decoded or decoded_sha:
                raw = decode_ids(enc, got)
                if decoded:
                    out[decoded].append(raw)
                if decoded_sha:
                    out[decoded_sha].append(hashlib.sha256(raw).hexdigest())
        columns = [batch.column(i) for i in range(batch.num_columns - 1)]
        return pa.RecordBatch.from_arrays(columns + [pa.array(out[k], v) for k, v in made.items()], [*kept, *made])

    return map_arrow(source, run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "bytes", pattern: str = PATTERN) -> DataFrame:
    """Raw bytes of every row's id array as a binary column ``out`` (NULL ids: NULL)."""
    shared = _ranks_reader(df.sparkSession, path)
    source = df.select(*[df[f"`{c}`"] for c in df.columns if c != out])
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields] + [f"`{out}` binary"])
    at = source.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value, pattern)
        for batch in batches:
            raw = [None if x is None else enc.decode_bytes(x) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], [*batch.schema.names, out])

    return map_arrow(source, run, schema)
