"""Best-fit packing of tokenised documents into fixed-length sequences.

Bounded-space online best-fit: a packer keeps at most ``open_bins`` sequences
open, in lists by free space, with one bit per free space that has any.  The
lowest set bit at or above a piece's length is the best fit; without one a new
sequence opens and, if that is one too many, the fullest open one closes.

Each document is its ids and an end id; longer ones are cut into pieces of
``capacity`` ids, the first piece taking the remainder.  Pieces are dealt
round-robin to packers of about ``per_packer`` pieces each, so neither a large
source nor a repeated document crowds one packer, and sorted within a
packer, so a repeated task packs the same way.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pieces_of, stored

CAPACITY = 1024
END_ID = 2
OPEN_BINS = 512
PER_PACKER = 100_000
#: Fixed value: how the byte-level pre-tokenizer cuts texts.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|"
           r"\s+(?!\S)|\s+")

# U+0000-U+024F less the controls on which regex engines differ as
# to white space, and general punctuation.
_ALIKE = re.compile(r"[\x00-\x1b\x20-\x84\x86-ɏ‐-‧€]*")


class TokenIds:
    """Ids of texts as little-endian uint32 bytes, as the tokenizer file gives them.

    A byte-level vocabulary is handed to the faster of the two libraries that
    implement it; a text with characters on which the two could differ, with a
    special token's text or with a run too long for that library, and any other kind
    of vocabulary, goes to the tokenizer itself."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        ranks = _ranks(path)
        self.fast = None
        if ranks is not None:
            import tiktoken
            self.fast = tiktoken.Encoding("ids", pat_str=PATTERN, mergeable_ranks=ranks,
                                          special_tokens={})

    def of(self, text: str) -> bytes:
        if (self.fast is not None and _ALIKE.fullmatch(text)
                and not (self.special and self.special.search(text))):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
            except ValueError:      # its pattern engine gives up on very long runs of blanks
                pass
        ids = self.whole.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, "<u4").tobytes()


def _ranks(path: str) -> dict[bytes, int] | None:
    """Byte strings of the vocabulary by id, if it is a plain byte-level one
    whose ids follow the order of its merges; else None."""
    import json
    with open(path, encoding="utf-8") as fh:
        model = json.load(fh)
    pre, bpe = model.get("pre_tokenizer") or {}, model["model"]
    if (model.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
            or bpe.get("type") != "BPE" or bpe.get("end_of_word_suffix")):
        return None
    # printable Latin-1 bytes stand for themselves, the others for U+0100 and up, in order
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    byte = {chr(b): b for b in plain}
    byte.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)})
    special = {t["content"] for t in model.get("added_tokens", [])}
    vocab = {t: i for t, i in bpe["vocab"].items() if t not in special}
    if any(c not in byte for t in vocab for c in t):
        return None
    merged = [vocab.get("".join(m if isinstance(m, list) else m.split(" "))) for m in bpe["merges"]]
    if None in merged or merged != sorted(merged):
        return None
    return {bytes(byte[c] for c in t): i for t, i in vocab.items()}


_LOADED: dict[str, TokenIds] = {}


def token_ids(path: str) -> TokenIds:
    """The worker's tokenizer for ``path``, loaded once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = TokenIds(path)
    return _LOADED[path]


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY, end_id: int = END_ID,
                 with_ids: bool = False) -> DataFrame:
    """Pieces of every document: id, piece (from 0), start, length, ids_crc32
    and, if ``with_ids``, ``input_ids`` as little-endian uint32 bytes."""
    end = np.asarray([end_id], "<u4").tobytes()
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([src.schema["id"], T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()),
                           T.StructField("ids_crc32", T.LongType())])
    if with_ids:
        schema = schema.add("input_ids", T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = token_ids(tokenizer).of
        for b in pieces_of(batches, 512):
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                own = ids_of(text or "") + end
                n, at, k = len(own) // 4, 0, 0
                while at < n:
                    size = ((n - 1) % capacity + 1) if k == 0 else capacity
                    part = own if size == n else own[4 * at:4 * (at + size)]
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
                    at, k = at + size, k + 1
            cols = [b.column(0).take(pa.array(row, pa.int32())), pa.array(piece, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            if with_ids:
                cols.append(pa.array(ids, pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return src.mapInArrow(run, schema)


class BestFit:
    """The packer: ``place(length)`` gives the sequence's number and the offset."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
        self.capacity, self.open_bins = capacity, open_bins
        self.free = 0                       # bit f: some open sequence has f free
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.open = self.made = 0

    def _take(self, f: int) -> int:
        own = self.by_free[f]
        number = own.pop()
        if not own:
            self.free ^= 1 << f
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        fits = self.free >> length
        if fits:
            f = length + (fits & -fits).bit_length() - 1
            number = self._take(f)
        else:
            if self.open == self.open_bins:
                self._take((self.free & -self.free).bit_length() - 1)
            f, number = self.capacity, self.made
            self.made += 1
        left = f - length
        if left:
            self.by_free[left].append(number)
            self.free |= 1 << left
            self.open += 1
        return number, self.capacity - f


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
                 per_packer: int = PER_PACKER) -> DataFrame:
    """``pieces`` (a stored table with ``length``) and for each row its
    ``sequence_id`` and ``offset``."""
    packers = max(1, -(-pieces.count() // per_packer))
    order = [F.xxhash64("id", "piece"), *[F.col(c) for c in pieces.columns]]
    dealt = pieces.repartition(packers).sortWithinPartitions(*order)
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = BestFit(capacity, open_bins)
        base = TaskContext.get().partitionId() << 40
        for b in batches:
            placed = [packer.place(n) for n in b.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([base + p[0] for p in placed], pa.int64()),
                 pa.array([p[1] for p in placed], pa.int64())], names=schema.names)

    return dealt.mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID, open_bins: int = OPEN_BINS,
         per_packer: int = PER_PACKER, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id,
    offset (and input_ids if ``with_ids``).

    A null or empty text is its end id alone, so every row has a piece.
    Repeated rows, null ids and rows with one id are packed as they come, each
    on its own.  Empty input gives no rows; other columns are ignored.
    ``tokenizer`` is the path of the tokenizer file on every executor."""
    pieces = stored(token_pieces(docs, tokenizer, id_col, text_col, capacity, end_id, with_ids),
                    "pieces")
    return place_pieces(pieces, capacity, open_bins, per_packer).withColumnRenamed("id", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from ``pack(..., with_ids=True)``: one
    row per sequence with its ids as little-endian uint32 bytes."""
    part = F.struct("offset", "input_ids")
    return (packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("p"))
            .select("sequence_id", F.aggregate(
                F.col("p.input_ids"), F.lit(b""), lambda a, x: F.concat(a, x)).alias("input_ids")))
