"""Exact byte-level BPE in linear time by backtracking over longest matches, and decoding by offsets.

An Aho-Corasick automaton over the vocabulary gives the longest token at every place of a word. The
encoder takes it if it may follow the last token, else the next shorter token that begins there, and
goes back over a token where none fits; a place that was found dead is never tried again. Two tokens may
follow each other if merging their joined bytes gives back these two: whether a merge would cross their
border before either is complete is read off their merge trees and kept in a pair table. A sequence
whose neighbours are all compatible is what merging by rank gives.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .common import arrow_map
from .pieces import PieceCache

VOCABULARY = "byte_bpe_50k.json"
# Pieces and compatibilities of token pairs that a worker keeps, so that its memory stays bounded.
CACHED_PIECES = 500_000
_KEPT_PAIRS = 300_000
_LATE = 1 << 60


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes printable bytes as themselves and the others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in printable}
    others = [b for b in range(256) if b not in letters]
    return letters | {b: chr(256 + i) for i, b in enumerate(others)}


class Codec:
    """Encoder and decoder of one tokenizer file; made once per worker by :func:`codec`."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.rank: dict[tuple[str, str], int] = {}
        self.parts: dict[str, tuple[str, str]] = {}
        self.made: dict[str, int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.rank[left, right] = rank
            if left + right not in self.parts:
                self.parts[left + right] = (left, right)
                self.made[left + right] = rank
        self.pairs: dict[int, bool] = {}
        usable = [t for t in self.ids if self._whole(t)]
        self.usable = set(usable)
        self.matcher = ahocorasick.Automaton()
        for token in usable:
            self.matcher.add_word(token, len(token))
        self.matcher.make_automaton()
        self.shorter = {t: self._next_prefix(t) for t in usable}
        self._offset_table()
        self.cache = PieceCache(self._encode_pieces, CACHED_PIECES)

    def _whole(self, token: str) -> bool:
        """A token that its own text encodes to: a letter, or a merge of two whole compatible parts."""
        if len(token) == 1:
            return True
        if token not in self.parts:
            return False
        left, right = self.parts[token]
        return self._crossing(left, right) == self.made[token] and self._whole(left) and self._whole(right)

    def _next_prefix(self, token: str) -> str | None:
        for size in range(len(token) - 1, 0, -1):
            if token[:size] in self.usable:
                return token[:size]
        return None

    def _crossing(self, left: str, right: str) -> int:
        """Rank of the first merge over the border of two tokens, or ``_LATE`` if there is none.

        Both sides grow as merging would let them: the tokens at the border are, from their last and
        first letter on, those along the right edge of the left tree and the left edge of the right one.
        """
        lefts, rights = [left], [right]
        while lefts[-1] in self.parts:
            lefts.append(self.parts[lefts[-1]][1])
        while rights[-1] in self.parts:
            rights.append(self.parts[rights[-1]][0])
        made = self.made
        while True:
            a, b = lefts[-1], rights[-1]
            next_left = made[lefts[-2]] if len(lefts) > 1 else _LATE
            next_right = made[rights[-2]] if len(rights) > 1 else _LATE
            over = self.rank.get((a, b), _LATE)
            # Equal ranks merge from the left: the left tree's goes before the border's, the right one's after.
            if over < next_left and over <= next_right and over < _LATE:
                return over
            if next_left == next_right == _LATE:
                return _LATE
            if next_left <= next_right:
                lefts.pop()
            else:
                rights.pop()

    def compatible(self, left: str, right: str) -> bool:
        pair = self.ids[left] << 32 | self.ids[right]
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= _KEPT_PAIRS:
                self.pairs.clear()
            known = self.pairs[pair] = self._crossing(left, right) == _LATE
        return known

    def word(self, word: str) -> list[int]:
        """Ids of one word, written in byte letters."""
        if word in self.usable:
            return [self.ids[word]]
        longest = [1] * len(word)
        for end, size in self.matcher.iter(word):
            start = end - size + 1
            if size > longest[start]:
                longest[start] = size
        taken: list[str] = []
        dead: set[int] = set()
        at, token = 0, word[: longest[0]]
        while True:
            end = at + len(token)
            if end not in dead and (not taken or self.compatible(taken[-1], token)):
                taken.append(token)
                at = end
                if at == len(word):
                    return [self.ids[t] for t in taken]
                token = word[at : at + longest[at]]
                continue
            while (shorter := self.shorter[token]) is None:
                dead.add(at)  # nothing fits from here on
                token = taken.pop()
                at -= len(token)
            token = shorter

    def _encode_pieces(self, pieces: list[str]) -> list[str]:
        """Decimal ids joined by commas."""
        return [",".join(map(str, self._encode_piece(piece))) for piece in pieces]

    def _encode_piece(self, piece: str) -> list[int]:
        found = [(piece.find(s), s) for s in self.special if s in piece]
        if found:
            at, name = min(found, key=lambda x: (x[0], -len(x[1])))
            rest = piece[at + len(name) :]
            return [*self._encode_piece(piece[:at]), self.special[name], *self._encode_piece(rest)]
        out: list[int] = []
        for word, _ in self.splitter.pre_tokenize_str(piece):
            out += self.word(word)
        return out

    def encode_decimals(self, texts: list[str]) -> list[str]:
        """Per text its ids in decimal, joined by commas."""
        return self.cache.of_texts(texts, lambda parts: ",".join(filter(None, parts)))

    def _offset_table(self) -> None:
        byte_of = {letter: byte for byte, letter in _byte_letters().items()}
        size = max([*self.ids.values(), *self.special.values()], default=-1) + 1
        raw = [b""] * size
        for token, i in self.ids.items():
            raw[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            raw[i] = token.encode()
        self.bytes = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids: each id's bytes are a slice of one buffer; bytes that are no UTF-8 become U+FFFD."""
        starts = self.offsets[ids]
        sizes = self.offsets[ids + 1] - starts
        ends = np.cumsum(sizes)
        if not len(ids) or not ends[-1]:
            return ""
        places = np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)
        return self.bytes[places].tobytes().decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}


def codec(vocabulary: str = VOCABULARY) -> Codec:
    """The codec of a worker. A bare name is a public tokenizer's file, else it is a path."""
    if vocabulary not in _CODECS:
        path = vocabulary if os.path.sep in vocabulary else public_tokenizers.path(vocabulary)
        _CODECS[vocabulary] = Codec(path)
    return _CODECS[vocabulary]


def parse_ids(decimals: str) -> np.ndarray:
    return np.fromstring(decimals, dtype=np.int64, sep=",") if decimals else np.empty(0, dtype=np.int64)


_SCHEMA = "doc_id long, n_tokens long, ids array<int>, decoded string, ids_sha256 string, decoded_sha256 string"


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, outputs: bool = True) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): ids, the text decoded from them, and digests of both.

    Null and empty texts have no tokens. Special tokens' strings in a text become their ids, as the
    tokenizers library does by default. Without ``outputs`` only the count and the digests come back.
    """
    kept = [f for f in T.StructType.fromDDL(_SCHEMA).fields if outputs or f.name not in ("ids", "decoded")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = codec(vocabulary)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            decimals = made.encode_decimals(texts)
            ids = [parse_ids(d) for d in decimals]
            decoded = [made.decode(i) for i in ids]
            columns = {
                "doc_id": batch.column(0).cast(pa.int64()),
                "n_tokens": pa.array([len(i) for i in ids], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decimals], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string()),
            }
            if outputs:
                columns["ids"] = pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32()))
                columns["decoded"] = pa.array(decoded, pa.string())
            names = [f.name for f in kept]
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run, T.StructType(kept))
