"""Cutting texts into pieces that a byte-level BPE tokenizer encodes independently, and caching them.

The tokenizer's own split never joins a character with white space after it. A text may thus be cut
before every run of white space, and the ids of the whole are the ids of its pieces in order. So it may
between a letter and a mark before white space, where the tokenizer always splits letters from marks. Most
pieces of a corpus repeat, so a task looks them up and encodes only new ones.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Hashable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SEPARATORS = re.compile("[\x1c-\x1f]")  # white space for Python, but not for the tokenizer
_RUNS = re.compile(r"\s*\S+|\s+")
# The tokenizer's white space: single bytes, and characters of several bytes.
_WHITE = np.isin(np.arange(256), list(b"\t\n\v\f\r "))
_LETTERS = np.isin(np.arange(256), list(string.ascii_letters.encode()))
_WIDE_WHITE = "\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WIDE_RUNS = re.compile(f"[\t-\r {_WIDE_WHITE}]*[^\t-\r {_WIDE_WHITE}]+|[\t-\r {_WIDE_WHITE}]+")


def keys_of(text: str) -> list[Hashable]:
    """Keys of the pieces: a string stands for itself after a space (or its own newline), a tuple for itself."""
    words = text.split()
    gaps, newlines = len(words) - 1, text.count("\n")
    # Nothing but one space or newline between words: there are as many as gaps, and no other white space.
    if words and gaps == text.count(" ") + newlines and sum(map(len, words)) + gaps == len(text):
        keys: list[Hashable] = text.replace("\n", " \n").split(" ") if newlines else words
        keys[0] = (keys[0],)
        return keys
    if _SEPARATORS.search(text):
        return [(text,)]
    return [(piece,) for piece in _RUNS.findall(text)]


def piece_of(key: Hashable) -> str:
    if isinstance(key, tuple):
        return key[0]
    return key if key.startswith("\n") else " " + key


def key_of(piece: str) -> Hashable:
    """The key of one piece, as ``keys_of`` gives it."""
    if piece[0] == " " and piece[1:2] != "\n":
        return piece[1:]
    return piece if piece[0] == "\n" else (piece,)


def cut(texts: pa.Array, marks: bytes = b"") -> tuple[pa.Array, np.ndarray]:
    """The pieces of all texts (large strings) in a row, as slices of the texts' bytes, and how many each text has.

    A mark after an ASCII letter and before white space or the end is a piece of its own, so that words with and without it are equal.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset) if len(texts) else np.zeros(1, np.int64)
    if offsets[-1] == offsets[0]:
        return pa.array([], pa.large_string()), np.zeros(len(texts), np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    white = _WHITE[data]
    begins = white.copy()
    begins[1:] &= ~white[:-1]
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    if marks:
        last = np.isin(np.arange(256), list(marks))[data]
        last[1:] &= _LETTERS[data[:-1]]
        last[:-1] &= begins[1:]  # white space or the next text
        begins |= last
    for row in np.flatnonzero(pc.match_substring_regex(texts, f"[{_WIDE_WHITE}]").fill_null(False)):
        # Rare: characters of several bytes are told apart as characters.
        sizes = [len(piece.encode()) for piece in _WIDE_RUNS.findall(texts[row].as_py())]
        begins[offsets[row] + 1 : offsets[row + 1]] = False
        begins[offsets[row] + np.cumsum(sizes)[:-1]] = True
    places = np.flatnonzero(begins)
    ends = np.append(places, len(data))
    pieces = pa.Array.from_buffers(pa.large_string(), len(places), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    return pieces, np.diff(np.searchsorted(places, offsets))


class PieceCache:
    """From keys to encoded pieces; ``encode`` gets the pieces that are not known yet.

    At most ``size`` pieces are kept, in two halves: when the young half is full, it becomes the old one,
    whose pieces return when they are met again. Frequent pieces thus stay and rare ones go.
    """

    def __init__(self, encode: Callable[[list[str]], list], size: int):
        self.encode, self.half = encode, max(1, size // 2)
        self.young: dict[Hashable, object] = {}
        self.old: dict[Hashable, object] = {}

    def of_texts(self, texts: list[str], join: Callable[[Iterable], Hashable]) -> list:
        """Per text what ``join`` makes of its encoded pieces."""
        keys = [keys_of(text) for text in texts]
        wanted, young, old = set().union(*keys), self.young, self.old
        absent = [k for k in wanted if k not in young]
        if len(young) + len(absent) > self.half:
            self.old, self.young = young, {}
            young, old = self.young, self.old
            absent = list(wanted)
        missing = []
        for key in absent:
            if key in old:
                young[key] = old[key]
            else:
                missing.append(key)
        young.update(zip(missing, self.encode([piece_of(k) for k in missing]), strict=True))
        get = young.__getitem__
        return [join(map(get, own)) for own in keys]


class _Numbers(dict):
    """Numbers of keys in the order of their first look-up."""

    def __init__(self):
        super().__init__()
        self.new: list[Hashable] = []

    def __missing__(self, key: Hashable) -> int:
        number = self[key] = len(self)
        self.new.append(key)
        return number


def _with_room(values: np.ndarray, used: int, more: int) -> np.ndarray:
    """The array itself, or one of twice its size that begins with its used part, if ``more`` do not fit."""
    if used + more <= len(values):
        return values
    grown = np.zeros(max(2 * len(values), used + more), values.dtype)
    grown[:used] = values[:used]
    return grown


class PieceTable:
    """From pieces to ids in one flat array: a call looks its distinct pieces up and gathers ids as arrays.

    ``encode`` gives the ids of new pieces, and where each piece's begin and how many they are. Beyond ``size``
    pieces only those stay that another call met since the last time, at most half of ``size``. ``marks``: ASCII
    characters that ``cut`` may part from a letter.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray, np.ndarray]], size: int, marks: bytes = b""):
        self.encode, self.size, self.marks = encode, size, marks
        self.numbers = _Numbers()
        # Per piece where its ids begin, how many they are, and the calls that met it; then room for more.
        self.starts, self.lengths, self.calls = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.flat, self.used = np.zeros(0, np.uint16), 0

    def _shrink(self) -> None:
        calls, half = self.calls[: len(self.numbers)], self.size // 2
        again = np.flatnonzero(calls > 1)
        if len(again) > half:
            again = np.sort(again[np.argsort(-calls[again], kind="stable")[:half]])
        keys, self.numbers = list(self.numbers), _Numbers()
        self.numbers.update((keys[old], new) for new, old in enumerate(again.tolist()))
        self.flat, self.lengths = self._gathered(again)
        self.starts = np.cumsum(self.lengths, dtype=np.int64) - self.lengths
        self.calls, self.used = np.ones(len(again), np.int32), len(self.flat)

    def _add(self) -> None:
        new, self.numbers.new = self.numbers.new, []
        ids, starts, lengths = self.encode([piece_of(k) for k in new])
        total = len(self.numbers)
        known = total - len(new)
        self.flat = _with_room(self.flat.astype(ids.dtype, copy=False), self.used, len(ids))
        self.starts, self.lengths, self.calls = (_with_room(v, known, len(new)) for v in (self.starts, self.lengths, self.calls))
        self.flat[self.used : self.used + len(ids)] = ids
        self.starts[known:total] = starts + self.used
        self.lengths[known:total] = lengths
        self.used += len(ids)

    def _gathered(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of numbered pieces in a row, and how many each has."""
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths, dtype=np.int64)
        shift = np.repeat(self.starts[numbers] - (ends - lengths), lengths)
        return self.flat[shift + np.arange(len(shift))], lengths

    def of_texts(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each text has."""
        if len(self.numbers) > self.size:
            self._shrink()
        column = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        pieces, counts = cut(column, self.marks)
        coded = pieces.dictionary_encode()
        # Most pieces repeat within a call: Python sees each once.
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = np.fromiter(map(self.numbers.__getitem__, map(key_of, distinct)), np.int32, len(distinct))
        if self.numbers.new:
            self._add()
        self.calls[numbers] += 1
        ids, lengths = self._gathered(numbers)
        width, ends = ids.itemsize, np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        # A piece's ids as one byte string, so that those of all pieces are put in a row at once.
        strings = [None, pa.py_buffer(ends * width), pa.py_buffer(ids)]
        row = pa.Array.from_buffers(pa.large_binary(), len(numbers), strings).take(coded.indices)
        if not len(row):
            return self.flat[:0], np.zeros(len(counts), np.int64)
        ends = np.frombuffer(row.buffers()[1], np.int64, len(row) + 1) // width
        places = np.concatenate([[0], np.cumsum(counts)])
        return np.frombuffer(row.buffers()[2], ids.dtype, ends[-1]), np.diff(ends[places])
