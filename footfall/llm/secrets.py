"""Operator 7: secrets, by one automaton for all rules (see ``automaton``).

Rules are compiled once, broadcast as small arrays, and every text is walked
once. Spans are in code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from footfall.llm.automaton import Scanner
from footfall.llm.common import extended, runs, strings, without

VALUE = re.compile(r"""^\w+["']?\x20*[:=]\x20*["']?(.*)$""", re.S)

# Kind, pattern, fewest bytes of a match (of its value for
# "assign"). The first three are the base rules; the others are published
# token formats.
RULES = [
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", 8),
    ("access", r"AKIA[A-Z0-9]+", 16),
    ("hex", r"[0-9a-f]{8,}", 32),  # runs are maximal, so the eight only spare short ones
    ("github", r"gh[oprsu]_[A-Za-z0-9]+", 40),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    ("key", r"-----BEGIN (RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----", 1),
]
BASE = 3
MASK = "[secret]"

SPAN = ArrayType(StructType().add("kind", StringType()).add("start", LongType()).add("end", LongType()))


def _scanner() -> Scanner:
    return Scanner([pattern for _, pattern, _ in RULES])


def _long_enough(rule: int, match: bytes) -> bool:
    kind, _, least = RULES[rule]
    return len(VALUE.match(match.decode())[1] if kind == "assign" else match) >= least


def _places(data: bytes, at: set[int]) -> dict[int, int]:
    """Code points before each of the given bytes, counted in one pass."""
    if data.isascii():
        return {b: b for b in at}
    out, last, count = {}, 0, 0
    for b in sorted(at):
        count += len(data[last:b].decode())
        out[b], last = count, b
    return out


def find(scanner: Scanner, texts: list[str]) -> list[list[tuple[str, int, int]]]:
    """Spans (kind, start, end) of each text, by start, then as the kinds are listed.
    A match that is too short is dropped; what it covered is not searched again."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for doc, rule, start, end in scanner.scan(raw):
        if _long_enough(rule, raw[doc][start:end]):
            found[doc].append((start, rule, end))
    out = []
    for data, spans in zip(raw, found):
        place = _places(data, {b for s, _, e in spans for b in (s, e)})
        out.append([(RULES[r][0], place[s], place[e]) for s, r, e in sorted(spans)])
    return out


def digest(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def secrets(docs: DataFrame, text_col: str = "text", out_col: str = "secrets") -> DataFrame:
    """``docs`` with ``out_col``: the secrets of the whole text as (kind, start,
    end). Null and empty texts have none. All rows and columns stay; a column
    already named so is replaced."""
    docs = without(docs, out_col)
    shared = docs.sparkSession.sparkContext.broadcast(_scanner())  # some hundred states
    at = docs.columns.index(text_col)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, text_col):
            spans = find(shared.value, strings(run.column(at)))
            rows = [[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in spans]
            yield pa.RecordBatch.from_arrays([*run.columns, pa.array(rows, kind)], [*run.schema.names, out_col])

    return docs.mapInArrow(run_all, extended(docs, **{out_col: SPAN}))


def joined(spans: str, only: tuple[str, ...] | None = None) -> F.Column:
    """kind:start:end of the spans (of the kinds named), comma-joined."""
    col = F.col(spans)
    if only:
        col = F.filter(col, lambda s: s["kind"].isin(*only))
    return F.concat_ws(",", F.transform(col, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def secret_digests(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans and all spans, per document."""
    base = tuple(k for k, _, _ in RULES[:BASE])
    found = secrets(docs.select("doc_id", "text"))

    def n(kind: str) -> F.Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[n(k) for k in base],
        F.sha2(joined("secrets", base).cast("binary"), 256).alias("base_sha256"),
        joined("secrets").alias("spans"),
    )


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with every span (and spans that overlap it) replaced by one mask,
    in one pass."""
    pieces, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: s[1:]):
        if start >= at:
            pieces += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*pieces, text[at:]])


def masked_texts(docs: DataFrame, text_col: str = "text", out_col: str = "masked") -> DataFrame:
    """``docs`` with ``out_col``: the text with its secrets masked, null where it
    has none (or is null or empty). All rows and columns stay; a column already
    named so is replaced."""
    docs = without(docs, out_col)
    shared = docs.sparkSession.sparkContext.broadcast(_scanner())  # some hundred states
    at = docs.columns.index(text_col)

    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, text_col):
            texts = strings(run.column(at))
            new = [mask(t, s) if s else None for t, s in zip(texts, find(shared.value, texts))]
            yield pa.RecordBatch.from_arrays([*run.columns, pa.array(new, pa.string())], [*run.schema.names, out_col])

    return docs.mapInArrow(run_all, extended(docs, **{out_col: StringType()}))
