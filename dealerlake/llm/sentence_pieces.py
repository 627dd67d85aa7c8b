"""SentencePiece encoding and decoding on the tokenizers library.

The model file's protobuf is read here field by field; normaliser, space marker, pieces with their
scores and byte fallback are rebuilt from it. Texts are encoded in multithreaded batches. Each distinct
word is encoded by the sentencepiece library too and decoded again when a task first meets it, and some
whole texts are: a difference raises an error.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from dealerlake.llm.common import byte_slices, record_batch, releasing

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
WORD = f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+"  # markers and what follows up to the next marker
# Fixed values of the file format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of each field of a protobuf message: an int, a float or bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 2:
            size = varint()
            at += size
            yield key >> 3, data[at - size : at]
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            at += size
            yield key >> 3, struct.unpack("<d" if kind == 1 else "<f", data[at - size : at])[0]
        else:
            raise ValueError(f"wire type {kind} is not used in model files")


@dataclass
class PieceModel:
    """What a model file says, with the format's defaults."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    trim_spaces: bool = True
    escape_spaces: bool = True
    marker_last: bool = False

    @classmethod
    def read(cls, data: bytes) -> PieceModel:
        model = cls()
        for number, value in fields(data):
            if number == 1:
                piece = dict(fields(value))
                model.pieces.append((piece.get(1, b"").decode(), piece.get(2, 0.0), piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(fields(value))
                model.kind = trainer.get(3, UNIGRAM)
                model.byte_fallback = bool(trainer.get(35, 0))
                model.marker_last = bool(trainer.get(24, 0))
            elif number == 3:
                spec = dict(fields(value))
                model.charsmap = spec.get(2, b"")
                model.dummy_prefix, model.trim_spaces, model.escape_spaces = (bool(spec.get(n, 1)) for n in (3, 4, 5))
        if model.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and byte-pair models can be rebuilt")
        if model.marker_last or not model.escape_spaces:
            raise ValueError("space markers after words, or none, are not supported")
        return model

    def by_word(self) -> bool:
        """Whether words can be encoded apart: no piece goes on over a marker that follows another character."""
        return not any(SPACE in text.lstrip(SPACE) for text, _, kind in self.pieces if kind in (NORMAL, USER))

    def merges(self) -> list[tuple[str, str]]:
        """Pairs of pieces that make a piece, best score first."""
        able = {text: score for text, score, kind in self.pieces if kind in (NORMAL, USER)}
        number = {text: n for n, (text, _, _) in enumerate(self.pieces)}
        found = []
        for text, score in able.items():
            pairs = [(text[:at], text[at:]) for at in range(1, len(text)) if text[:at] in able and text[at:] in able]
            found += [(-score, number[text], number[a], number[b], a, b) for a, b in pairs]
        return [(a, b) for *_, a, b in sorted(found)]

    def tokenizer(self):
        """The same encoder and decoder as a Tokenizer."""
        from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

        unknown = next((n for n, p in enumerate(self.pieces) if p[2] == UNKNOWN), None)
        if self.kind == UNIGRAM:
            core = models.Unigram([(t, s) for t, s, _ in self.pieces], unk_id=unknown, byte_fallback=self.byte_fallback)
        else:
            core = models.BPE(
                {t: n for n, (t, _, _) in enumerate(self.pieces)}, self.merges(), fuse_unk=True,
                unk_token=None if unknown is None else self.pieces[unknown][0], byte_fallback=self.byte_fallback,
            )
        made = Tokenizer(core)
        steps = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.trim_spaces:
            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ | $"), "")]
        steps.append(normalizers.Replace(" ", SPACE))
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(SPACE))
        made.normalizer = normalizers.Sequence(steps)
        if self.by_word():
            made.pre_tokenizer = pre_tokenizers.Split(Regex(WORD), "isolated")
        parts = [decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse()]
        if self.dummy_prefix:
            parts.append(decoders.Strip(" ", 1, 0))
        made.decoder = decoders.Sequence(parts)
        return made


@dataclass(frozen=True)
class Tokenization:
    model: str = DEFAULT_MODEL  # read on the driver; the file's bytes travel to the tasks
    threads: int = 2
    verify_every: int = 64  # one text in so many, by a hash, is also compared as a whole, beside its words


class Encoder:
    """A tokenizer in a task, and the library it is held against.

    Where words can be encoded apart, each is encoded, decoded and compared once and remembered, else
    each text is. Words used of late stay: the memory has two halves of ``remembered`` bytes, and when
    the younger is full, the older goes. Long words are not remembered.
    """

    def __init__(self, data: bytes, threads: int, remembered: int = 32 << 20, long_word: int = 64):
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        import sentencepiece
        from tokenizers import normalizers

        self.model = PieceModel.read(data)
        self.tokenizer = self.model.tokenizer()
        self.tokenizer.normalizer = self.tokenizer.pre_tokenizer = None  # given words of normalised text
        self.other = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.mapped = normalizers.Precompiled(self.model.charsmap) if self.model.charsmap else None
        self.parts = re.compile(WORD if self.model.by_word() else r"(?s).+").findall
        self.remembered, self.long_word = remembered, long_word
        self.size = 0  # bytes in ``ids``, about
        self.ids: dict[str, bytes] = {}  # 32-bit numbers
        self.older: dict[str, bytes] = {}
        self.long: list[str] = []  # words to forget after their texts
        self.changed: dict[str, str] = {}  # what decoding makes of words that it does not give back

    def _learn(self, words: set[str]) -> None:
        """Make ``ids`` hold all the words."""
        if self.size > self.remembered:
            self.older, self.ids, self.size = self.ids, {}, 0
        missing = list(filterfalse(self.ids.__contains__, words))
        known = list(filter(self.older.__contains__, missing))
        self._keep(known, list(map(self.older.__getitem__, known)))
        fresh = list(filterfalse(self.older.__contains__, missing))
        if not fresh:
            return
        found = [f.ids for f in self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False)]  # on several threads
        front = 1 if self.model.dummy_prefix else 0
        raw = [w.replace(SPACE, " ")[front:] for w in fresh]
        others = self.other.encode(raw, num_threads=1)
        if found != others:
            for word, text, ids, other in zip(fresh, raw, found, others, strict=True):
                if ids != other and self.normalized(text) == word:
                    raise ValueError(f"a word of {len(word)} characters is encoded otherwise by sentencepiece")
        # All at once, since decoding puts pieces one after the other; word by word only to find out which differ.
        if self.tokenizer.decode(list(chain.from_iterable(found)), skip_special_tokens=False) != "".join(fresh).replace(SPACE, " ")[front:]:
            decoded = self.tokenizer.decode_batch(found, skip_special_tokens=False)
            self.changed |= {w: " " * front + back for w, text, back in zip(fresh, raw, decoded, strict=True) if back != text}
        self._keep(fresh, [array("i", ids).tobytes() for ids in found])
        self.long = [w for w in fresh if len(w) > self.long_word]

    def _keep(self, words: list[str], ids: list[bytes]) -> None:
        self.ids.update(zip(words, ids, strict=True))
        self.size += 4 * sum(map(len, words)) + sum(map(len, ids)) + 200 * len(words)

    def _forget_long(self) -> None:
        for word in self.long:
            ids = self.ids.pop(word)
            self.size -= 4 * len(word) + len(ids) + 200
            self.changed.pop(word, None)
        self.long = []
        if len(self.changed) * 400 > self.remembered:  # of words long gone, perhaps
            self.changed, self.ids, self.older, self.size = {}, {}, {}, 0

    def forget(self) -> None:
        """Give up all words, so that a worker that waits for its next task holds the tokenizer only."""
        self.ids, self.older, self.changed, self.size = {}, {}, {}, 0

    def normalized(self, text: str) -> str:
        """What the model's normaliser gives."""
        if self.mapped:
            text = self.mapped.normalize_str(text)
        if self.model.trim_spaces:
            text = re.sub(" {2,}", " ", text).strip(" ")
        text = text.replace(" ", SPACE)
        return SPACE + text if text and self.model.dummy_prefix else text

    def encode(self, texts: Sequence[str]) -> tuple[list[np.ndarray], list[bool]]:
        """Token ids of each text, and whether decoding them gives the text back."""
        normal = [self.normalized(t) for t in texts]
        words = [self.parts(n) for n in normal]
        collecting = gc.isenabled()
        gc.disable()  # looking for cycles among so many lists, which hold none, takes a tenth of the time
        try:
            self._learn(set().union(*words))
        finally:
            if collecting:
                gc.enable()
        ids = [np.frombuffer(b"".join(map(self.ids.__getitem__, w)), np.int32) for w in words]
        front = 1 if self.model.dummy_prefix else 0
        restored = []
        for text, plain, held in zip(texts, normal, words, strict=True):
            back = plain.replace(SPACE, " ")
            if self.changed and not self.changed.keys().isdisjoint(held):
                back = "".join([self.changed.get(w) or w.replace(SPACE, " ") for w in held])
            restored.append(back[front:] == text)
        self._forget_long()
        return ids, restored

    def decode(self, ids: Sequence[np.ndarray]) -> list[str]:
        return self.tokenizer.decode_batch([i.tolist() for i in ids], skip_special_tokens=False)

    def verify(self, texts: Sequence[str], ids: Sequence[np.ndarray], restored: Sequence[bool]) -> None:
        """Raise ValueError if sentencepiece encodes one of the texts otherwise, or decoding says otherwise."""
        others = self.other.encode(list(texts), num_threads=1)
        for text, own, other, back, ok in zip(texts, ids, others, self.decode(ids), restored, strict=True):
            if own.tolist() != other or (back == text) != ok:
                raise ValueError(f"a text of {len(text)} characters is encoded or decoded otherwise by sentencepiece")


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def _encoder(data: bytes, threads: int) -> Encoder:
    """The process's encoder for this model: building one takes a second."""
    key = (hashlib.sha256(data).hexdigest(), threads)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(data, threads)
    return _ENCODERS[key]


def encode(docs: DataFrame, settings: Tokenization = Tokenization(), with_ids: bool = True) -> DataFrame:
    """doc_id, token_ids, n_tokens, ids_sha256, restored of every row.

    ``restored`` says that decoding gives back the text exactly. The digest is of the ids as 32-bit
    little-endian numbers. A NULL or empty text has no tokens and is restored. Rows that repeat stay
    repeated; a NULL doc_id stays NULL. Further columns are not read.
    """
    with open(settings.model, "rb") as file:
        data = file.read()
    shared = docs.sparkSession.sparkContext.broadcast(data)  # the vocabulary file
    kinds = [("doc_id", pa.int64()), ("token_ids", pa.list_(pa.int32())), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("restored", pa.bool_())]
    schema = pa.schema([k for k in kinds if with_ids or k[0] != "token_ids"])
    ddl = f"doc_id long, {'token_ids array<int>, ' if with_ids else ''}n_tokens long, ids_sha256 string, restored boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value, settings.threads)
        try:
            for batch in batches:
                for first, raw in byte_slices(batch.column("text")):
                    texts = [t.decode() for t in raw]
                    ids, restored = encoder.encode(texts)
                    held = [n for n, t in enumerate(raw) if zlib.crc32(t) % settings.verify_every == 0]
                    encoder.verify([texts[n] for n in held], [ids[n] for n in held], [restored[n] for n in held])
                    digests = [hashlib.sha256(i.tobytes()).hexdigest() for i in ids]
                    doc_ids = batch.column("doc_id").slice(first, len(texts))
                    sizes = np.array([len(i) for i in ids])
                    lists = pa.ListArray.from_arrays(np.append(0, np.cumsum(sizes)).astype(np.int32), np.concatenate(ids))
                    columns = [doc_ids, lists, sizes, digests, restored] if with_ids else [doc_ids, sizes, digests, restored]
                    yield record_batch(schema, columns)
        finally:
            encoder.forget()

    return docs.select("doc_id", "text").mapInArrow(releasing(run), ddl)


def report(docs: DataFrame, settings: Tokenization = Tokenization()) -> DataFrame:
    """What ``encode`` returns, without the tokens themselves."""
    return encode(docs, settings, with_ids=False)
