"""Personal data in text: fixed patterns, and a conditional random field over word shapes.

The field is trained on the small labelled table below and labels the words of every line by
Viterbi over the whole line, in numpy batches. Runs of equally labelled words become spans.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from dealerlake.llm.chain_crf import ChainCRF, Layout, best_path
from dealerlake.llm.common import Ranges, byte_slices, record_batch

SLICE = 6 << 20  # more lines at once mean fewer Viterbi steps
# The base patterns. An address starts only where its first number does, and an e-mail
# is looked for around each @; this changes no match and keeps long runs linear.
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone")

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        domain = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield "email", start, done
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Base matches by kind as listed, then start. Offsets count code points, the end is exclusive."""
    spans = list(_emails(text))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                spans.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                spans.append(("phone", *m.span()))
    return spans


# --- the field ------------------------------------------------------------------------

#: Training table: words in brackets carry the label before the colon, all others none.
LABELLED = """
Please contact {name:Mr. Anna Weber} about the order.
We met {name:Mrs. Carla Gomez} in the office.
Signed by {name:Dr. Paul Martin} on the first page.
Ask {name:Prof. John Miller} for the paper.
{name:Herr Klaus Schmidt} hat den Vertrag.
Bitte {name:Frau Eva Fischer} fragen.
Avec {name:Mme Claire Dubois} dans le bureau.
Par {name:M. Louis Bernard} et la direction.
El {name:Sr. Pablo Torres} de la empresa.
La {name:Sra. Marta Ruiz} con el contrato.
Mail to {contact:anna.weber@mail.org} for more.
Write {contact:info@shop.example.com} today.
My mail is {contact:j-doe@example} thanks.
Call {contact:+1 555 010 2233} after nine.
Call {contact:(030) 1234 5678} now.
Or call {contact:040-7654321} today.
Ask her or call {contact:0171-555123}.
The number to call {contact:0221-998877}.
Mail him or call {contact:0711-123987}.
Tel. {contact:030-1234567} in the morning.
phone: {contact:555-0102} or come by.
Tel: {contact:+49 30 901820} please.
Fax {contact:089/123456} only.
Card {number:4111 1111 1111 1111} was used.
Paid by card {number:5500-0000-0000-0004} online.
IBAN {number:DE89 3704 0044 0532 0130 00} for the rent.
IBAN: {number:GB29NWBK60161331926819} as agreed.
SSN {number:078-05-1120} on file.
ssn: {number:219-09-9999} was given.
Passport {number:C01X00T47} was shown.
Server {number:192.168.10.12} answered.
from host {number:10.0.0.7} at night.
The and for with that this. Then they went to the house.
It was in 2019 and again in 2021 that the work began.
There were 12 of them and 300 more in the next room.
Chapter 3 has 45 pages. See page 112 for the list.
The price was 1,200.50 in May and 1.300,00 later.
On 2020-01-15 the list had 17 lines at 12:30.
Das Haus und die Stadt. Der Mann kam mit dem Hund.
Le chat est dans la maison. Les enfants sont en ville.
La casa es de la familia. El perro y los gatos.
Was Was Was the the the. And And And of of of.
Sich Sich Sich Sich Sich Sich Sich Sich und und und und.
Und Und Und Und Und Und Und die die die die die.
Wher. Wher. Wher. Wher. Wher. Th Th Th Th Th is is.
THE HOUSE IS OPEN!! COME IN!! ALL OF YOU!!
alpha | beta | gamma | delta | one | two
word%%% other### more*** again&&& last$$$
Contact us for more. Call the office. Mail it soon. They call it.
Version 2.1.3 was out. Use port 8080 or 443.
Home - News - Shop - Login - Help. Copyright 2020.
Licensed under the terms. No warranty of any kind.
See http://shop.example.com/page/12 for the rest.
token=abcdef012345 password: hunter2 secret=xyz
Mr. and the house. The card is red. Tel and fax.
Be. Erin. Then by the way.
To. Anna. And so on.
Licensed under the Apache License, Version 2.0 and more.
This is under the GNU General Public License, version 3.
The City Council and the Board of Trade met. Good Day.
A. The. Er. In. On. Le. La. Der.
Item 17: red, blue and green. Total 25 of 40.
"""
NONE, LABELS = "none", ("none", "name", "contact", "number")
#: Words that announce what follows, in the groups that a feature tells apart.
CUES = (
    ("mr.", "mrs.", "ms.", "dr.", "prof.", "herr", "frau", "mme", "m.", "sr.", "sra."),
    ("mail", "email", "e-mail", "write", "contact"),
    ("call", "tel", "tel.", "tel:", "phone", "phone:", "fax"),
    ("card", "iban", "iban:", "ssn", "ssn:", "passport", "server", "host", "ip"),
)
MARKS = "@.-+:/()"


def _byte_marks() -> np.ndarray:
    """A random number per byte; a word's sum of them, lower case, looks up its cue group."""
    marks = np.random.default_rng(11).integers(0, 2**63, 256).astype(np.uint64)
    for c in range(ord("A"), ord("Z") + 1):
        marks[c] = marks[c + 32]
    return marks


BYTE_MARK = _byte_marks()
CUE_OF = sorted((int(BYTE_MARK[list(w.encode())].sum()), g + 1) for g, words in enumerate(CUES) for w in words)
CUE_KEYS = np.array([k for k, _ in CUE_OF], np.uint64)
CUE_GROUPS = np.array([g for _, g in CUE_OF])
WIDTHS = (6, 6, 12, 16, 16, 5, 4)  # bins of each feature


def _byte_kinds() -> tuple[np.ndarray, np.ndarray]:
    """What one byte adds to a word's counts of digits, capitals and other letters; which mark it is."""
    counted, held = np.zeros(256, np.int64), np.zeros(256, np.uint16)
    counted[ord("0") : ord("9") + 1] = 1
    counted[ord("A") : ord("Z") + 1] = 1 << 20
    counted[ord("a") : ord("z") + 1] = counted[128:] = 1 << 40
    for k, mark in enumerate(MARKS):
        held[ord(mark)] = 1 << k
    return counted, held


COUNTED, HELD = _byte_kinds()


@dataclass(frozen=True)
class Words:
    """Words of a batch of texts: byte ranges in the joined bytes, words of each line that has any, own bins."""

    starts: np.ndarray
    ends: np.ndarray
    lines: np.ndarray
    own: list[np.ndarray]  # per feature, below its WIDTHS

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Which words open and which close a line."""
        last = np.cumsum(self.lines)
        opens, closes = np.zeros(len(self.starts), bool), np.zeros(len(self.starts), bool)
        opens[last - self.lines], closes[last - 1] = True, True
        return opens, closes

    def bins(self) -> np.ndarray:
        """Table rows of each word's own features and of those of the words before and after it in the line."""
        own = np.column_stack(self.own)
        opens, closes = self.edges()
        back, ahead = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
        back[opens], ahead[closes] = WIDTHS, WIDTHS
        return np.column_stack([own + OFFSETS, back + OFFSETS + BLOCK, ahead + OFFSETS + 2 * BLOCK])


def read_words(joined: np.ndarray) -> Words:
    """Words are runs of bytes other than blanks. The last byte must be a newline."""
    blank = (joined == 32) | ((joined >= 9) & (joined <= 13))
    before = np.concatenate([[True], blank[:-1]])
    starts = np.flatnonzero(~blank & before)
    ends = np.flatnonzero(blank & ~before)
    if not len(starts):
        return Words(starts, ends, np.zeros(0, np.int64), [np.zeros(0, np.int64)] * len(WIDTHS))
    lengths = ends - starts
    newlines = np.flatnonzero(joined == 10)
    lines = np.diff(np.searchsorted(starts, newlines), prepend=0)
    # Digits, capitals and small letters counted together, in three parts of one number.
    summed = np.concatenate([[0], np.cumsum(COUNTED[joined])])
    counts = summed[ends] - summed[starts]
    digits, uppers, lowers = counts & PART, counts >> 20 & PART, counts >> 40
    letters = uppers + lowers
    marks = np.bitwise_or.reduceat(HELD[joined], starts)
    summed = np.concatenate([[np.uint64(0)], np.cumsum(BYTE_MARK[joined])])
    sums = summed[ends] - summed[starts]
    found = np.minimum(np.searchsorted(CUE_KEYS, sums), len(CUE_KEYS) - 1)
    cue = np.where(CUE_KEYS[found] == sums, CUE_GROUPS[found], 0)
    first = COUNTED[joined[starts]] == 1 << 20
    case = np.select([letters == 0, uppers == 0, first & (uppers == 1), lowers == 0, first], [0, 1, 2, 3, 4], 5)
    own = [
        SIZES[np.minimum(lengths, 31)],
        DIGITS[np.minimum(digits, 31)],
        case + 6 * ((digits > 0) & (digits < letters)),
        marks & 15,
        marks >> 4 & 15,
        cue,
        (digits + letters < lengths) + 2 * (digits == lengths),
    ]
    return Words(starts, ends, lines[lines > 0], [f.astype(np.int64) for f in own])


PART = (1 << 20) - 1
SIZES = np.searchsorted([1, 2, 4, 8, 16], np.arange(32))
DIGITS = np.searchsorted([1, 3, 5, 9, 17], np.arange(32), side="right")
OFFSETS = np.cumsum([0, *[w + 1 for w in WIDTHS[:-1]]])
BLOCK = sum(w + 1 for w in WIDTHS)


class Field:
    """A trained field with its tables summed over two groups of features, so that a word takes six lookups."""

    GROUPS = ((0, 1, 5, 6), (2, 3, 4))

    def __init__(self, crf: ChainCRF):
        self.moves = crf.moves.astype(np.float32)
        self.tables = []
        for block in range(3):
            for group in self.GROUPS:
                total = np.zeros((1, len(LABELS)))
                for f in group:
                    rows = block * BLOCK + OFFSETS[f] + np.arange(WIDTHS[f])
                    total = (total[:, None, :] + crf.table[rows][None]).reshape(-1, len(LABELS))
                none = sum(crf.table[block * BLOCK + OFFSETS[f] + WIDTHS[f]] for f in group)
                self.tables.append(np.concatenate([total, none[None]]).astype(np.float32))

    def unary(self, words: Words) -> np.ndarray:
        opens, closes = words.edges()
        total = np.zeros((len(words.starts), len(LABELS)), np.float32)
        for g, group in enumerate(self.GROUPS):
            code = np.zeros(len(words.starts), np.int64)
            for f in group:
                code = code * WIDTHS[f] + words.own[f]
            back, ahead = np.roll(code, 1), np.roll(code, -1)
            back[opens] = ahead[closes] = len(self.tables[g]) - 1
            for block, rows in enumerate((code, back, ahead)):
                total += self.tables[2 * block + g][rows]
        return total


ROWS = 3 * BLOCK


def labelled_rows(table: str = LABELLED) -> tuple[bytes, list[int]]:
    """The table's text without its marks, and the label of each word."""
    plain, labels = [], []
    for line in table.strip().splitlines():
        for inside, label, outside in re.findall(r"\{(\w+:)([^}]*)\}|([^{]+)", line):
            words = (label or outside).split()
            plain.extend(words)
            labels.extend([LABELS.index(inside[:-1]) if inside else 0] * len(words))
        plain.append("\n")
    return " ".join(plain).encode(), labels


def train(table: str = LABELLED, steps: int = 200) -> Field:
    text, labels = labelled_rows(table)
    words = read_words(np.frombuffer(text + b"\n", np.uint8))
    return Field(ChainCRF(ROWS, len(LABELS)).fit(words.bins(), np.array(labels), words.lines, steps, 0.1, 0.003))


def field_spans(texts: Sequence[bytes], crf: Field) -> list[list[Span]]:
    """Runs of equally labelled words in each text. Punctuation at a run's end is left out."""
    joined = np.frombuffer(b"".join(t + b"\n" for t in texts), np.uint8)
    spans: list[list[Span]] = [[] for _ in texts]
    words = read_words(joined)
    if not len(words.starts):
        return spans
    # In 64 bits: scores grow along a line, which may be a whole text.
    path = best_path(crf.unary(words).astype(np.float64), crf.moves, Layout.of(words.lines))
    line = np.repeat(np.arange(len(words.lines)), words.lines)
    hit = np.flatnonzero(path)
    if not len(hit):
        return spans
    offsets = np.cumsum([0, *[len(t) + 1 for t in texts]])
    points = np.concatenate([[0], np.cumsum(joined & 0xC0 != 0x80)])  # code points before each byte
    fresh = np.concatenate([[True], (np.diff(hit) > 1) | (path[hit[1:]] != path[hit[:-1]]) | (line[hit[1:]] != line[hit[:-1]])])
    firsts = hit[fresh]
    lasts = hit[np.concatenate([np.flatnonzero(fresh)[1:] - 1, [len(hit) - 1]])]
    for a, b in zip(firsts, lasts, strict=True):
        owner = int(np.searchsorted(offsets, words.starts[a], side="right")) - 1
        text, start, end = texts[owner], int(words.starts[a] - offsets[owner]), int(words.ends[b] - offsets[owner])
        while end > start + 1 and text[end - 1 : end] in b".,;:!?":
            end -= 1
        begin = int(points[offsets[owner] + start] - points[offsets[owner]])
        spans[owner].append((f"crf_{LABELS[path[a]]}", begin, begin + len(text[start:end].decode())))
    return spans


def find_spans(texts: Sequence[bytes], crf: Field) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text: the field's spans join where they touch no base span."""
    found = []
    for text, more in zip(texts, field_spans(texts, crf), strict=True):
        base = base_spans(text.decode())
        taken = Ranges([b[1:] for b in base])
        extra = [s for s in more if not taken.touch(*s[1:])]
        found.append((base, base + sorted(extra)))
    return found


def written(spans: Sequence[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


OUT = pa.schema(
    [("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()), ("spans", pa.string())]
)


def scan_personal_data(docs: DataFrame, crf: Field | None = None) -> DataFrame:
    """Per row: doc_id, counts of base spans, SHA-256 of the written base spans, all spans.

    A NULL text is empty and has none. Rows that repeat stay repeated, a NULL doc_id stays NULL.
    Further columns are not read.
    """
    crf = crf or train()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in byte_slices(batch.column("text"), SLICE):
                found = find_spans(texts, crf)
                counts = [[sum(s[0] == kind for s in base) for base, _ in found] for kind in KINDS]
                digests = [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found]
                ids = batch.column("doc_id").slice(first, len(texts))
                yield record_batch(OUT, [ids, *counts, digests, [written(every) for _, every in found]])

    return docs.select("doc_id", "text").mapInArrow(
        scan, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    )
