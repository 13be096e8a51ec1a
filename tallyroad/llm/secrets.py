"""Secret scans: patterns, and entropy of sliding windows.

Three base kinds are plain patterns. The fourth, ``entropy``, looks at
candidate strings of a character class (hexadecimal digits, base64), moves a
window of fixed width over each and keeps the Shannon entropy of the window up
to date by the two counts that change. Allow-list patterns are looked for in the
whole candidate; windows that overlap what they match are passed over, and each
stretch between is reported from the first window over the class's threshold to
the end of the last one, unless a base span covers it. Short windows have to hold
several kinds of characters as well, as words and paths of 16 letters have about
the entropy of a random string.

Positions are code points, ends exclusive. A null text has no spans. Texts of
any length are scanned whole; a scan takes time in proportion to the text.
"""

from __future__ import annotations

import math
import re
import string
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyroad.llm.common import fresh

KINDS = ("assign", "access", "hex", "entropy")
BASE_KINDS = KINDS[:3]
MASK = "[SECRET]"

# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_LENGTH = 12
# Runs are maximal, so the least length can be part of the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")


@dataclass(frozen=True)
class CharClass:
    """Candidates of a class: their pattern, and the window that decides. It
    has ``least`` characters of every string in ``kinds``."""

    pattern: str
    width: int
    bits: float
    kinds: tuple[str, ...] = ()
    least: int = 2


# A random string of the class stays above these values in most windows, words
# and numbers stay below. A hexadecimal window of 24 characters has 4 bits at
# most, a base64 one log2(24) = 4.58; one of 16 has 4 in either class.
CASES = (string.digits, string.ascii_uppercase, string.ascii_lowercase)
CLASSES = (
    CharClass(r"[0-9A-Fa-f]{16,}", 16, 3.0, (string.digits, "abcdefABCDEF")),
    CharClass(r"[A-Za-z0-9+/_-]{16,}={0,2}", 16, 3.5, CASES),
    CharClass(r"[A-Za-z0-9+/_-]{20,}={0,2}", 20, 3.7, CASES),
    CharClass(r"[0-9A-Fa-f]{24,}", 24, 3.2),
    CharClass(r"[A-Za-z0-9+/_-]{24,}={0,2}", 24, 4.05),
)

# What looks random but is no secret.
ALLOWED = (
    r"^[0-9]+$",
    r"^[A-Za-z]+$",
    r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}(?![0-9A-Fa-f])",
    r"(?i)example|sample|placeholder|dummy|changeme|redacted",
    r"(?i)abcdefghij|0123456789",
)

SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def scan(text: str | None, classes: Sequence[CharClass] = CLASSES, allowed: Iterable[str] = ALLOWED) -> list:
    """Spans ``(start, kind number, end)`` of one text, in order."""
    return Scanner(classes, allowed).spans(text)


class Scanner:
    def __init__(self, classes: Sequence[CharClass], allowed: Iterable[str]):
        self.classes = [(re.compile(c.pattern), c) for c in classes]
        self.allowed = [re.compile(a) for a in allowed]

    def spans(self, text: str | None) -> list[tuple[int, int, int]]:
        if not text:
            return []
        found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LENGTH]
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
        random = set()
        for pattern, rule in self.classes:
            for m in pattern.finditer(text):
                for a, b in self.gaps(m[0]):
                    hot = random_part(m[0][a:b], rule.width, rule.bits, rule.kinds, rule.least)
                    if hot:
                        random.add((m.start() + a + hot[0], m.start() + a + hot[1]))
        base = sorted((s, e) for s, _, e in found)
        found += [(s, 3, e) for s, e in widest(random) if not any(a <= s and e <= b for a, b in base)]
        return sorted(found)


    def gaps(self, candidate: str) -> Iterator[tuple[int, int]]:
        """The stretches between allow-list matches."""
        at = 0
        for start, end in widest({m.span() for a in self.allowed for m in a.finditer(candidate) if m[0]}):
            yield at, start
            at = end
        yield at, len(candidate)


def widest(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping spans of several classes as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def random_part(
    text: str, width: int, bits: float, kinds: Sequence[str] = (), least: int = 0
) -> tuple[int, int] | None:
    """From the first to the last window whose entropy is at least ``bits`` and
    that has ``least`` characters of each of ``kinds``.

    H = log2(w) - sum(c log2 c) / w over the counts c, so a step changes two
    terms of one sum. Rounding cannot pile up: the terms come from a table, in
    whole multiples of 2**-40.
    """
    if len(text) < width:
        return None
    unit = 1 << 40
    terms = [0] + [round(c * math.log2(c) * unit) for c in range(1, width + 1)]
    most = (math.log2(width) - bits) * width * unit
    counts: dict[str, int] = {}
    total = 0
    first = last = None
    for i, char in enumerate(text):
        c = counts.get(char, 0)
        counts[char] = c + 1
        total += terms[c + 1] - terms[c]
        if i >= width:
            old = text[i - width]
            c = counts[old]
            counts[old] = c - 1
            total += terms[c - 1] - terms[c]
        if i >= width - 1 and total <= most and all(sum(counts.get(c, 0) for c in kind) >= least for kind in kinds):
            first = i - width + 1 if first is None else first
            last = i + 1
    return None if first is None else (first, last)


def find(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    classes: Sequence[CharClass] = CLASSES,
    allowed: Iterable[str] = ALLOWED,
) -> DataFrame:
    """``id_col, spans``: one row per input row, spans sorted by start and
    kind (in the order of ``KINDS``)."""
    allowed = tuple(allowed)
    key = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(classes, allowed)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            rows = [
                [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in scanner.spans(t.as_py())]
                for t in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=[id_col, "spans"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {key}, spans {SPANS}")


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def redact(
    docs: DataFrame,
    text_col: str = "text",
    length_col: str | None = "n_chars",
    classes: Sequence[CharClass] = CLASSES,
    allowed: Iterable[str] = ALLOWED,
) -> DataFrame:
    """The same rows and columns, each secret in the text replaced by
    ``MASK``. ``length_col``, where the table has it, follows the new text of
    changed rows."""
    allowed = tuple(allowed)

    @F.pandas_udf("string")
    def masked(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(classes, allowed)
        for texts in parts:
            yield pd.Series([None if t is None else mask(t, scanner.spans(t)) for t in texts], dtype=object)

    new = fresh(docs, "masked")
    out = docs.withColumn(new, masked(F.col(text_col)))
    columns = []
    for c in docs.columns:
        if c == text_col:
            columns.append(F.col(new).alias(c))
        elif c == length_col:
            changed = ~F.col(new).eqNullSafe(F.col(text_col))
            length = F.length(new).cast(docs.schema[c].dataType)
            columns.append(F.when(changed, length).otherwise(F.col(c)).alias(c))
        else:
            columns.append(F.col(f"`{c}`"))
    return out.select(columns)


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    if not spans:
        return text
    parts, at = [], 0
    for start, end in widest({(s, e) for s, _, e in spans}):
        parts += [text[at:start], MASK]
        at = end
    return "".join([*parts, text[at:]])
