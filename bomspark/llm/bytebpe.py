"""Byte-level BPE encoding and decoding with a serialised sentencepiece model.

A vocabulary of byte strings with ranks becomes a sentencepiece BPE model, written
as its protocol buffer: every token is a piece whose bytes are mapped to one
printable character each and whose score is its negative rank, and the normaliser
is the identity.  The library merges the neighbours whose joint piece scores
highest, leftmost first, which is the merge of lowest rank.  Texts are cut into
pre-tokens by the vocabulary's pattern, each is encoded alone, and ids are
decoded by the inverse of the byte mapping.

A pre-token that is itself a token is that token, also where merging would not
lead to it.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_texts, pieces_of

#: Fixed value: how texts are cut before merging.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|"
           r"\s+(?!\S)|\s+")
#: Encoded pre-tokens that a worker remembers (up to twice as many), and the longest
#: that it does.
REMEMBERED = 1 << 17
REMEMBERED_CHARS = 64
#: Characters of texts whose new pre-tokens are encoded in one call.
_AT_ONCE = 1 << 20
#: Scores are 32-bit floats, which hold integers up to this exactly.
_MAX_RANK = 1 << 24


def byte_chars() -> list[str]:
    """One character per byte: U+0100 and the byte, none of which is blank."""
    return [chr(0x100 + b) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: lines of a token in base 64 and its rank."""
    with open(path, "rb") as fh:
        return {base64.b64decode(t): int(r) for t, r in (x.split() for x in fh if x.strip())}


# ------------------------------------------------------------------ the model file

def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | str | int | float) -> bytes:
    """One protocol-buffer field: text and messages by length, integers as
    varints, numbers with a fraction as 32-bit floats."""
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    raw = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(raw)) + raw


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """The serialised model of ``tokens`` in order of rank; piece i is token i,
    and one more piece stands for characters that the vocabulary lacks.

    Fixed values (fields of the public model format): pieces 1 (piece 1, score 2,
    type 3: normal 1, unknown 2), trainer 2 (model type 3: BPE 2), normaliser 3
    (name 1, dummy prefix 3, extra blanks removed 4, blanks escaped 5)."""
    if len(tokens) > _MAX_RANK:
        raise ValueError(f"a vocabulary of more than {_MAX_RANK} tokens is not supported")
    char = byte_chars()
    out = [_field(1, _field(1, "".join(char[b] for b in t)) + _field(2, float(-i)) + _field(3, 1))
           for i, t in enumerate(tokens)]
    out.append(_field(1, _field(1, "<unknown>") + _field(2, 0.0) + _field(3, 2)))
    out.append(_field(2, _field(3, 2)))
    out.append(_field(3, _field(1, "identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)))
    return b"".join(out)


# ------------------------------------------------------------------ pre-tokens

class Cutter:
    """Cuts texts into the matches of a pattern written in ``\\p{L}``, ``\\p{N}`` and
    ``\\s``.

    The pattern's engine here may know a newer Unicode than the library whose
    cuts are wanted: of a text with characters that the two class differently, a
    shadow is cut that has stand-ins of the right class in their place."""

    #: Characters below this have been classed alike for long.
    OLD = "԰"
    STAND_IN = {"L": "a", "N": "0", "": "☃"}

    def __init__(self, pattern: str = PATTERN):
        import tiktoken
        single = {bytes([b]): b for b in range(256)}
        self.match = regex.compile(pattern).findall
        self.spans = regex.compile(pattern).finditer
        self.probes = {k: tiktoken.Encoding(k, pat_str=rf"\p{{{k}}}", mergeable_ranks=single,
                                            special_tokens={}) for k in "LN"}
        self.own = {k: regex.compile(rf"\p{{{k}}}") for k in "LN"}
        self.shadow: dict[int, str] = {}
        self.seen: set[str] = set()

    def _learn(self, chars: set[str]) -> None:
        """Ask the library for the class of characters not met before."""
        for c in chars:
            theirs = next((k for k in "LN" if self.probes[k].encode_ordinary(c)), "")
            ours = next((k for k in "LN" if self.own[k].match(c)), "")
            if theirs != ours:
                self.shadow[ord(c)] = self.STAND_IN[theirs]
        self.seen |= chars

    def cut(self, text: str) -> list[str]:
        if not text.isascii() and max(text) >= self.OLD:
            chars = {c for c in set(text) if c >= self.OLD}
            if not chars <= self.seen:
                self._learn(chars - self.seen)
            if self.shadow and any(ord(c) in self.shadow for c in chars):
                return [text[m.start():m.end()]
                        for m in self.spans(text.translate(self.shadow))]
        return self.match(text)


# ------------------------------------------------------------------ the codec

class ByteBpe:
    """Encoder and decoder of one vocabulary; ids are its ranks.  Either half is made
    when it is first used, as a worker mostly needs one."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        lacking = [b for b in range(256) if bytes([b]) not in ranks]
        if lacking:
            raise ValueError(f"the vocabulary lacks the bytes {lacking[:10]}")
        self.tokens = sorted(ranks, key=ranks.__getitem__)
        self.ids = [ranks[t] for t in self.tokens]
        self.pattern = pattern
        self.to_chars = dict(enumerate(byte_chars()))
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    @cached_property
    def model(self):
        import sentencepiece
        return sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(self.tokens))

    @cached_property
    def cut(self):
        return Cutter(self.pattern).cut

    @cached_property
    def whole(self) -> dict[bytes, bytes]:
        """Tokens that merging does not lead to."""
        merged = self.model.encode([self._mapped(t) for t in self.tokens], num_threads=1)
        return {t: self._bytes([i]) for i, (t, m) in enumerate(zip(self.tokens, merged))
                if m != [i]}

    @cached_property
    def bytes_of(self) -> dict[int, bytes]:
        """Bytes of the pieces by id: the inverse of the mapping."""
        byte = {c: b for b, c in self.to_chars.items()}
        return {i: bytes(map(byte.__getitem__, self._mapped(t)))
                for i, t in zip(self.ids, self.tokens)}

    def _mapped(self, raw: bytes) -> str:
        return raw.decode("latin-1").translate(self.to_chars)

    def _bytes(self, pieces: list[int]) -> bytes:
        return struct.pack(f"<{len(pieces)}I", *map(self.ids.__getitem__, pieces))

    def _learn(self, missing: list[str]) -> dict[str, bytes]:
        raw = [m.encode() for m in missing]
        found = self.model.encode([self._mapped(r) for r in raw], num_threads=1)
        return {m: self.whole.get(r) or self._bytes(f) for m, r, f in zip(missing, raw, found)}

    def _remember(self, new: dict[str, bytes]) -> None:
        """Half of what is remembered goes when that half is full, the one not asked
        for lately."""
        self.known.update((m, i) for m, i in new.items() if len(m) <= REMEMBERED_CHARS)
        if len(self.known) > REMEMBERED:
            self.known, self.before = {}, self.known

    def _encode(self, texts: list[str]) -> list[bytes]:
        cuts = [self.cut(t) for t in texts]
        found = [list(map(self.known.get, c)) for c in cuts]
        missing = {c for cs, fs in zip(cuts, found) if None in fs
                   for c, f in zip(cs, fs) if f is None}
        if missing:
            new = {c: self.before[c] for c in missing if c in self.before}
            new.update(self._learn(list(missing.difference(new))))
            found = [[new[c] if f is None else f for c, f in zip(cs, fs)] if None in fs else fs
                     for cs, fs in zip(cuts, found)]
            self._remember(new)
        return [b"".join(f) for f in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out, held, chars = [], [], 0
        for text in texts:
            held.append(text)
            chars += len(text)
            if chars >= _AT_ONCE:
                out += self._encode(held)
                held, chars = [], 0
        return out + self._encode(held)

    def decode(self, ids: bytes) -> bytes:
        """Bytes of ids; an id that the vocabulary lacks is a KeyError."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_LOADED: dict[tuple[str, str], ByteBpe] = {}


def codec(path: str, pattern: str = PATTERN) -> ByteBpe:
    """The worker's codec for a rank file, loaded once per Python worker."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = ByteBpe(read_ranks(path), pattern)
    return _LOADED[path, pattern]


def encode(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text",
           pattern: str = PATTERN) -> DataFrame:
    """One row per input row: its id and ``input_ids``, little-endian unsigned
    32-bit integers.

    A null or empty text has no ids.  Repeated rows and null ids are encoded as
    they come; empty input gives no rows; other columns are ignored.  Bytes that
    are not UTF-8 become U+FFFD first.  A text of any length is encoded whole, by
    one task.  ``ranks`` is the rank file's path on every executor."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField(id_col, src.schema["id"].dataType),
                           T.StructField("input_ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces_of(batches, 512):
            texts = [(t or b"").decode("utf-8", "replace") for t in byte_texts(b, "text")]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(codec(ranks, pattern).encode(texts), pa.binary())],
                names=schema.names)

    return src.mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks: str, ids_col: str = "input_ids",
           out_col: str = "decoded", pattern: str = PATTERN) -> DataFrame:
    """``encoded`` with the bytes that its ids stand for (null ids: null).  A column
    of that name that is there already is replaced."""
    src = encoded.drop(out_col)
    at = src.columns.index(ids_col)
    schema = T.StructType([*src.schema.fields, T.StructField(out_col, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = codec(ranks, pattern).decode
            raw = [None if i is None else own(i) for i in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(raw, pa.binary())],
                                             names=schema.names)

    return src.mapInArrow(run, schema)
