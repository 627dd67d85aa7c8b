"""Secrets in text: fixed patterns, and strings whose characters look drawn at random.

A window slides over a candidate string while counts of the characters inside, and from them the Shannon
entropy, are kept up to date step by step. Each window has the narrowest character class it fits. Windows
at or over their class's threshold are joined to spans, unless they overlap an allow-list entry or the
letters and digits it is part of. Of such a span, the parts outside base spans count.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from dealerlake.llm.common import Ranges, byte_slices, record_batch

# The base patterns and their smallest lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
DIGIT = re.compile("[0-9]")
WORD = re.compile("[A-Za-z0-9+]+")
WORDS = ("passw", "secret", "token", "api")  # a text holding none of these has no assignment
ASSIGN_VALUE, ACCESS_LENGTH = 6, 20
KINDS = ("assign", "access", "hex")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Base matches by start, then kind as listed. Offsets count code points, the end is exclusive."""
    lower = text.lower()
    spans = []
    if any(word in lower for word in WORDS):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


@dataclass(frozen=True)
class CharacterClass:
    """Bits of entropy that a window of characters of this class must reach."""

    pattern: str
    bits: float


@dataclass(frozen=True)
class EntropyRules:
    """Classes are tried in order, narrowest first. A window counts only if it holds a digit and a letter."""

    window: int = 20
    classes: tuple[CharacterClass, ...] = (
        CharacterClass(r"[0-9a-f]+", 3.2),
        CharacterClass(r"[0-9A-F]+", 3.2),
        CharacterClass(r"[A-Z0-9]+", 3.7),
        CharacterClass(r"[a-z0-9]+", 3.7),
        CharacterClass(r"[A-Za-z0-9+/_=-]+", 3.9),
    )
    #: Strings found inside well-known examples and placeholders, and identifiers that are not secret.
    allowed: tuple[str, ...] = (
        r"(?i)example|sample|dummy|placeholder|changeme|redacted|xxxxx",
        r"(?i)0123456789|123456789|abcdefgh|qwerty",
        r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    )
    candidate: re.Pattern = field(default=re.compile(r"[A-Za-z0-9+/_=-]{20,}"))


def high_windows(text: str, window: int, bits: float) -> list[tuple[int, int]]:
    """Joined ranges of the windows with at least ``bits`` of entropy and both a digit and a letter."""
    found: list[tuple[int, int]] = []
    counts: dict[str, int] = {}
    weight = [c * math.log2(c) if c else 0.0 for c in range(window + 1)]
    total, digits, letters = 0.0, 0, 0
    most = window * (math.log2(window) - bits) + 1e-9  # entropy = log2(w) - sum(c log2 c) / w
    for at, char in enumerate(text):
        count = counts.get(char, 0)
        total += weight[count + 1] - weight[count] if count < window else 0.0
        counts[char] = count + 1
        digits += char.isdigit()
        letters += char.isalpha()
        if at >= window:
            old = text[at - window]
            count = counts[old]
            total += weight[count - 1] - (weight[count] if count <= window else weight[window])
            counts[old] = count - 1
            digits -= old.isdigit()
            letters -= old.isalpha()
        if at >= window - 1 and total <= most and digits and letters:
            first = at - window + 1
            if found and found[-1][1] >= first:
                found[-1] = (found[-1][0], at + 1)
            else:
                found.append((first, at + 1))
    return found


def entropy_spans(text: str, rules: EntropyRules = EntropyRules()) -> list[Span]:
    spans = []
    if not DIGIT.search(text):  # no window can count
        return spans
    for candidate in rules.candidate.finditer(text):
        value, start = candidate[0], candidate.start()
        matches = [m.span() for pattern in rules.allowed for m in re.finditer(pattern, value)]
        words = [m.span() for m in WORD.finditer(value)] if matches else []
        matched = Ranges(matches)
        allowed = Ranges(matches + [w for w in words if matched.touch(*w)])
        found: list[tuple[int, int]] = []
        for rule, first, end in class_runs(value, rules):
            for x, y in allowed.outside(first, end):
                found += [(x + a, x + b) for a, b in high_windows(value[x:y], rules.window, rule.bits)]
        joined: list[tuple[int, int]] = []
        for a, b in sorted(found):
            if joined and joined[-1][1] >= a:
                joined[-1] = (joined[-1][0], max(joined[-1][1], b))
            else:
                joined.append((a, b))
        spans += [("entropy", start + a, start + b) for a, b in joined]
    return spans


def class_runs(value: str, rules: EntropyRules) -> Iterator[tuple[CharacterClass, int, int]]:
    """Longest parts of ``value`` that fit a class and hold a window; a part inside a narrower class's is left out."""
    held: list[tuple[int, int]] = []
    for rule in rules.classes:
        runs = [m.span() for m in re.finditer(rule.pattern, value) if m.end() - m.start() >= rules.window]
        narrower = Ranges(held)
        runs = [(a, b) for a, b in runs if not narrower.hold(a, b)]
        yield from ((rule, a, b) for a, b in runs)
        held += runs


def find_spans(text: str, rules: EntropyRules = EntropyRules()) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans): of an entropy span, the parts outside base spans join."""
    base = base_spans(text)
    taken = Ranges([b[1:] for b in base])
    extra = [("entropy", *part) for s in entropy_spans(text, rules) for part in taken.outside(*s[1:])]
    order = (*KINDS, "entropy")
    return base, sorted(base + extra, key=lambda s: (s[1], order.index(s[0]), s[2]))


def written(spans: Sequence[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


OUT = pa.schema(
    [("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()), ("spans", pa.string())]
)


def scan_secrets(docs: DataFrame, rules: EntropyRules = EntropyRules()) -> DataFrame:
    """Per row: doc_id, counts of base spans, SHA-256 of the written base spans, all spans.

    A NULL text is empty and has none. Rows that repeat stay repeated, a NULL doc_id stays NULL.
    Further columns are not read.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in byte_slices(batch.column("text")):
                found = [find_spans(t.decode(), rules) for t in texts]
                counts = [[sum(s[0] == kind for s in base) for base, _ in found] for kind in KINDS]
                digests = [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found]
                ids = batch.column("doc_id").slice(first, len(texts))
                yield record_batch(OUT, [ids, *counts, digests, [written(every) for _, every in found]])

    return docs.select("doc_id", "text").mapInArrow(
        scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )
