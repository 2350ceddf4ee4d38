"""Token counts by a linear longest-match automaton.

The vocabulary's pieces are a trie over bytes; the last byte of a word is a
symbol of its own, as pieces that end a word are entries of their own.  Every
node has a failure link and the number of pieces that greedy longest match
gives off on the way there, so a word is counted in one pass over its bytes, with
no backing up and without building its pieces.  Each word is counted once per
worker and remembered.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_texts

END = "</w>"
CACHED_WORDS = 500_000


def read_pieces(path: str) -> list[tuple[bytes, bool]]:
    """(bytes, ends a word) of every piece of a byte-level vocabulary with word
    ends in a tokenizer file."""
    with open(path, encoding="utf-8") as fh:
        file = json.load(fh)
    # printable Latin-1 bytes stand for themselves, the others for U+0100 and up, in order
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    byte = {chr(b): b for b in plain}
    byte.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)})
    special = {t["content"] for t in file.get("added_tokens", [])}
    pieces = []
    for piece in file["model"]["vocab"]:
        if piece not in special:
            ends = piece.endswith(END)
            body = piece[:-len(END)] if ends else piece
            pieces.append((bytes(byte[c] for c in body), ends))
    return pieces


def symbols(word: bytes, ends: bool) -> list[int]:
    """Bytes of a piece or word; the last one shifted by 256 if it ends a word."""
    return [*word[:-1], word[-1] + 256] if ends else list(word)


class LongestMatch(dict):
    """Pieces per word (bytes), greedy from the left; at least all single bytes,
    inside and at the end of a word, must be pieces, so that none is unknown."""

    def __init__(self, pieces: list[tuple[bytes, bool]], cached: int = CACHED_WORDS):
        super().__init__()
        self.cached = cached
        self.next: list[dict[int, int]] = [{}]
        is_piece = [False]
        for body, ends in pieces:
            node = 0
            for s in symbols(body, ends):
                child = self.next[node].get(s)
                if child is None:
                    child = self.next[node][s] = len(self.next)
                    self.next.append({})
                    is_piece.append(False)
                node = child
            is_piece[node] = node > 0
        if any(not is_piece[self.next[0].get(s, 0)] for s in range(512)):
            raise ValueError("every byte must be a piece, inside and at the end of a word")
        self.fail, self.popped = self._links(is_piece)

    def _links(self, is_piece: list[bool]) -> tuple[list[int], list[int]]:
        """Per node: where matching goes on if no child fits, and the pieces
        given off on the way (-1: the string at the node cannot be cut)."""
        fail, popped = [0] * len(self.next), [0] * len(self.next)
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for s, node in self.next[parent].items():
                queue.append(node)
                if is_piece[node]:
                    popped[node] = 1
                    continue
                at, given = fail[parent], popped[parent]
                while s not in self.next[at]:     # the root has every symbol
                    given += popped[at]
                    at = fail[at]
                fail[node], popped[node] = self.next[at][s], given
        return fail, popped

    def count(self, word: bytes) -> int:
        node, pieces = 0, 0
        for s in symbols(word, True):
            while s not in self.next[node]:
                pieces += self.popped[node]
                node = self.fail[node]
            node = self.next[node][s]
        while node:
            pieces += self.popped[node]
            node = self.fail[node]
        return pieces

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.cached:
            self.clear()
        n = self[word] = self.count(word)
        return n


_LOADED: dict[str, LongestMatch] = {}


def automaton(path: str) -> LongestMatch:
    if path not in _LOADED:
        _LOADED[path] = LongestMatch(read_pieces(path))
    return _LOADED[path]


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, n_tokens of the whole text with A-Z
    lower-cased (words are runs of anything but ASCII blanks).

    Null, empty and blank texts have none.  Repeated rows and null ids keep
    their row.  Empty input gives no rows; other columns are ignored."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([src.schema["id"], T.StructField("n_words", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = automaton(vocabulary).__getitem__
        for b in batches:
            words, tokens = [], []
            for text in byte_texts(b, "text"):
                own = (text or b"").lower().split()
                words.append(len(own))
                tokens.append(sum(map(pieces, own)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                names=schema.names)

    return src.mapInArrow(run, schema).withColumnRenamed("id", id_col)
