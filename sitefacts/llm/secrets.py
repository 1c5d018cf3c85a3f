"""Secret scan with multipart credential linking.

Strong findings stand alone. Weak candidates (access identifiers, secret-like values, service endpoints) are noise on
their own; they are reported when an interval join finds parts that complement each other near by in one scope, that
is in one paragraph.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitefacts.llm.batches import text_chunks

KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")  # the order of spans that start together
REACH = 200  # code points around a part within which others belong to it, not counting the parts between

BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),  # a run of 24 or more: shorter runs fail anyway
)
WEAK = (
    ("weak_id", re.compile(r"(?:AKIA|ASIA|AROA|AIDA)[A-Z0-9]{8,}|(?i:client_?id|user_?name|access_?id|account|login)[\"']?\x20*[:=]\x20*[\"']?[\w.@+-]{3,}", re.A)),
    ("weak_secret", re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}(?![A-Za-z0-9+/_=-])")),
    ("endpoint", re.compile(r"(?:https?|ftp|amqps?|redis|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|jdbc:[a-z]+)://[^\s\"'<>]{3,}")),
)
PARAGRAPH = re.compile(r"\n[\x20\t\r]*\n")
SECRET_BITS = 3.0  # entropy per character that a weak secret needs
ROLE = {"assign": "secret", "hex": "secret", "access": "id", "weak_id": "id", "weak_secret": "secret", "endpoint": "endpoint"}
COMPLEMENTS = {"id": ("secret",), "secret": ("id", "endpoint"), "endpoint": ("secret",)}


def looks_random(value: str) -> bool:
    """Letters and digits mixed, with little repetition; ordinary words and numbers fail."""
    core = value.rstrip("=")
    if core.isalpha() or core.isdigit() or not any(c.isdigit() for c in core):
        return False
    counts = Counter(core)
    return -sum(n / len(core) * math.log2(n / len(core)) for n in counts.values()) >= SECRET_BITS


def strong_spans(text: str) -> list[tuple[int, int, str]]:
    return [
        (m.start(), m.end(), kind)
        for kind, pattern, group, least in BASE
        for m in pattern.finditer(text)
        if m.end(group) - m.start(group) >= least
    ]


def weak_spans(text: str) -> list[tuple[int, int, str]]:
    return [
        (m.start(), m.end(), kind)
        for kind, pattern in WEAK
        for m in pattern.finditer(text)
        if kind != "weak_secret" or looks_random(m.group())
    ]


def overlapping(spans: list[tuple[int, int, str]], others: list[tuple[int, int, str]]) -> np.ndarray:
    """Which spans share a character with one of the others."""
    if not spans or not others:
        return np.zeros(len(spans), bool)
    starts = np.sort([s for s, _, _ in others])
    ends = np.sort([e for _, e, _ in others])
    # the spans that began before this one ends, less those that ended before it starts
    return np.searchsorted(starts, [e for _, e, _ in spans]) > np.searchsorted(ends, [s for s, _, _ in spans], side="right")


def joined_parts(text: str, parts: list[tuple[int, int, str]], reach: int) -> np.ndarray:
    """Which parts have a complement: an interval join of the parts with the widened parts of other roles.

    A part's interval is widened by ``reach`` and clipped to its paragraph. Sorted bounds are searched, so the work
    grows with the parts and not with their pairs.
    """
    bounds = np.array([0, *(m.end() for m in PARAGRAPH.finditer(text)), len(text) + 1])
    starts, ends = np.array([p[0] for p in parts]), np.array([p[1] for p in parts])
    scope = np.searchsorted(bounds, starts, side="right") - 1
    low, high = np.maximum(starts - reach, bounds[scope]), np.minimum(ends + reach, bounds[scope + 1])
    roles = np.array([ROLE[p[2]] for p in parts])
    found = np.zeros(len(parts), bool)
    for role, wanted in COMPLEMENTS.items():
        own = roles == role
        for other in wanted:
            theirs = roles == other
            begun = np.searchsorted(np.sort(starts[theirs]), high[own])
            over = np.searchsorted(np.sort(ends[theirs]), low[own], side="right")
            found[own] |= begun > over
    return found


def squeezed(text: str, parts: list[tuple[int, int, str]]) -> tuple[str, list[tuple[int, int, str]]]:
    """The text and its parts with each part, or run of overlapping parts, as one character.

    Distances in it are those of what lies between the parts, so a long key does not part those on its two sides.
    """
    pieces, places, at, size = [], {}, 0, 0
    for start, end, _ in sorted(parts):
        if start >= at:
            pieces += [text[at:start], "x"]
            size += start - at + 1
        places[start, end] = size
        at = max(at, end)
    return "".join(pieces) + text[at:], [(places[s, e] - 1, places[s, e], k) for s, e, k in parts]


def find_spans(text: str, reach: int = REACH) -> list[tuple[int, int, str]]:
    """All reported spans by start and kind: the strong ones, and weak candidates that a complement supports."""
    strong = strong_spans(text)
    weak = weak_spans(text)
    covered = overlapping(weak, strong)
    weak = [w for w, hit in zip(weak, covered) if not hit]
    if weak:
        parts = strong + weak
        linked = joined_parts(*squeezed(text, parts), reach)
        strong += [p for p, hit in zip(parts[len(strong) :], linked[len(strong) :]) if hit]
    return sorted(strong, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """``id_col`` and ``spans``, an array of ``(kind, start, stop, strong)`` in code points, for every document.

    Null and empty texts have no spans. Repeated rows give repeated rows; null ids pass; other columns are left out.
    Each text is handled whole in its own row, so there is no shuffle and no group.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("strong", pa.bool_())])
        for batch in text_chunks(batches):
            rows = [
                [{"kind": k, "start": s, "stop": e, "strong": KINDS.index(k) < len(BASE)} for s, e, k in find_spans(text, reach)]
                for text in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(rows, pa.list_(kind))], names=["id", "spans"])

    id_type = docs.schema[id_col].dataType.simpleString()
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        find, f"id {id_type}, spans array<struct<kind: string, start: bigint, stop: bigint, strong: boolean>>"
    )
    return found.select(F.col("id").alias(id_col), "spans")


def span_list(spans: Column) -> Column:
    """Spans as text: ``kind:start:stop`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
