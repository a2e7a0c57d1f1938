"""Secret scan: known shapes, and random strings by their characters per token.

Text costs a byte-pair vocabulary few tokens, random strings many. Every run of key characters is
encoded; runs of few characters per token are reported, after digests of known lengths, UUIDs, numbers
and identifiers (words and numbers joined by marks) are excluded. Words are told by their tokens, too.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.functions import arrow_udf

from tallyfold.llm.common import fresh, text_or_empty

KINDS = ("assign", "access", "hex")  # base kinds, in the order that ties in start take
RANDOM = "random"
MIN_CHARS, MAX_CHARS_PER_TOKEN = 20, 2.1
SPANS = "array<struct<kind:string,start:int,end:int>>"
SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                     r"""([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]+")
_NAMES = ("password", "passwd", "secret", "token", "api")
DIGEST_CHARS = (32, 40, 56, 64, 96, 128)  # hex digits of MD5, SHA-1, SHA-224, -256, -384, -512
_HEX_ONLY = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_MARKS = re.compile(r"[+/_=-]+")


def is_dense(run: str, encoding: tiktoken.Encoding) -> bool:
    """So few characters per token as random strings have."""
    return len(run) <= MAX_CHARS_PER_TOKEN * len(encoding.encode_ordinary(run))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base kinds' spans in code points, by start, then kind."""
    found = []
    lower = text.lower()
    if any(name in lower for name in _NAMES):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def is_excluded(run: str, encoding: tiktoken.Encoding) -> bool:
    """Digests, UUIDs, and words and numbers joined by marks.

    One or two letters tell nothing; the other parts must hold more than half of the characters.
    """
    if _UUID.fullmatch(run) or len(run) in DIGEST_CHARS and _HEX_ONLY.fullmatch(run):
        return True
    parts = [p for p in _MARKS.split(run) if p]
    telling = [p for p in parts if len(p) > 2 or p.isdigit()]
    return not parts or (
        2 * sum(map(len, telling)) > sum(map(len, parts)) and all(
            p.isdigit() or not is_dense(p, encoding) for p in telling))


def random_spans(text: str, encoding: tiktoken.Encoding) -> list[tuple[str, int, int]]:
    """Runs of key characters that take more tokens than text would."""
    if not any(len(w) >= MIN_CHARS for w in text.split()):
        return []
    return [(RANDOM, *m.span()) for m in _RUN.finditer(text)
            if len(m[0]) >= MIN_CHARS and is_dense(m[0], encoding)
            and not is_excluded(m[0], encoding)]


def load_encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("secrets", pat_str=pattern, mergeable_ranks=merges, special_tokens={})


def all_spans(text: str, encoding: tiktoken.Encoding) -> list[tuple[str, int, int]]:
    """Base spans, and random runs that no base span overlaps, by start, then kind."""
    base = base_spans(text)
    more = [s for s in random_spans(text, encoding)
            if not any(b[1] < s[2] and s[1] < b[2] for b in base)]
    return sorted(base + more, key=lambda s: (s[1], (*KINDS, RANDOM).index(s[0])))


def masked(text: str, spans: list[tuple[str, int, int]], mask: str) -> str:
    """The text with every stretch that spans cover replaced by ``mask``."""
    parts, at = [], 0
    for _, start, end in spans:
        if start >= at:
            parts += [text[at:start], mask]
        at = max(at, end)
    return "".join(parts) + text[at:]


def scanner(spark: SparkSession, ranks_path: str, pattern: str, mask: str | None = None):
    """An Arrow UDF of a text column: its spans, or with ``mask`` the masked text (null: no span).

    The ranks file (the size of one vocabulary) reaches the executors as a broadcast.
    """
    with open(ranks_path, "rb") as file:
        ranks = spark.sparkContext.broadcast(file.read())

    @arrow_udf(SPANS if mask is None else "string")
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoding = load_encoding(ranks.value, pattern)
        for batch in batches:
            texts = (t.as_py() for t in batch)
            if mask is None:
                yield pa.array([[dict(zip(("kind", "start", "end"), s))
                                 for s in all_spans(t, encoding)] for t in texts], SPAN_TYPE)
            else:
                yield pa.array([masked(t, s, mask) if (s := all_spans(t, encoding)) else None
                                for t in texts], pa.string())

    return scan


def secret_spans(docs: DataFrame, ranks_path: str, pattern: str,
                 text: str | Column = "text") -> DataFrame:
    """``docs`` with an array column ``secrets`` (underscores if taken) of (kind, start, end).

    Positions are code points, end exclusive. Null or empty texts have none; every row stays,
    repeated ones too; an empty table gives an empty one. No shuffle.
    """
    scan = scanner(docs.sparkSession, ranks_path, pattern)
    return docs.withColumn(fresh(docs, "secrets"), scan(text_or_empty(text)))


def redacted(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text",
             n_chars: str = "n_chars", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with masked texts and, where a text changed, its new length in ``n_chars``.

    Columns and rows stay; null texts stay null; without an ``n_chars`` column none is made.
    """
    scan = scanner(docs.sparkSession, ranks_path, pattern, mask)
    new = fresh(docs, "masked")
    changed = docs.withColumn(new, scan(text_or_empty(text)))
    value = {text: F.coalesce(F.col(new), F.col(text))}
    if n_chars in docs.columns:
        value[n_chars] = F.when(F.col(new).isNull(), F.col(n_chars)).otherwise(
            F.length(new).cast(docs.schema[n_chars].dataType))
    return changed.select(*[value.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
