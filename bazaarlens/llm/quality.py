"""Quality rules by distribution divergence.

A document's histogram of character classes and its histogram of the language's common words are each
compared with the reference of its language, by Jensen-Shannon divergence (base 2). A document drawn from its
language still diverges by chance, the more the shorter it is: the limit is the divergence expected at its
length, ``SPREADS`` times its expected spread, and an allowance for what documents are about. Documents too
short for a histogram to mean anything pass that comparison. The base rules stand before the divergence.

References are built over all documents that pass the base rules, each with the same weight, and copies
and near copies once: documents of a language with the same least rolling hash (32 bytes, lower case) are
represented by one. A language's reference depends on that language's documents alone; it is a row of a table
that documents are joined to by language, so there may be any number of languages.
"""

from __future__ import annotations

import json
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import lookup_join, written
from .common import LOWER, arrow_map, opened, sealed, texts_of, words_of

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Words of a language's histogram; every other word is counted as one further class.
COMMON_WORDS = 200
# Fewer characters or words than this, and the divergence is not judged.
MIN_CLASS_CHARS = 200
MIN_COMMON_WORDS = 50
# Divergence allowed beyond chance, and how many expected spreads of chance.
WORD_ALLOWANCE = CLASS_ALLOWANCE = 0.05
SPREADS = 4.0
# Characters come in words and are no independent draws: so many words count as one draw of a character class.
WORDS_PER_DRAW = 4
# Bytes of the rolling hash by which near copies are found.
_NEAR_BYTES = 32
# The characters counted as symbols.
_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\x0b\x0c\r"
CLASSES = ("lower", "upper", "digit", "space", "stop", "symbol", "other ascii", "beyond ascii")


def _class_of(byte: int) -> int | None:
    if 97 <= byte <= 122:
        return 0
    if 65 <= byte <= 90:
        return 1
    if 48 <= byte <= 57:
        return 2
    if byte in _SPACE:
        return 3
    if byte in b".,;:!?'\"()-":
        return 4
    if byte in _SYMBOLS:
        return 5
    if byte < 128:
        return 6
    return 7 if byte >= 192 else None  # a continuation byte is no character


_OF_BYTE = np.zeros((256, len(CLASSES)), dtype=np.int64)
for _b in range(256):
    if _class_of(_b) is not None:
        _OF_BYTE[_b, _class_of(_b)] = 1
_IS_SYMBOL = np.array([b in _SYMBOLS for b in range(256)], dtype=np.int64)


def class_counts(text: bytes) -> tuple[np.ndarray, int, int]:
    """Characters of each class, symbols, and code points in words."""
    seen = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    classes = seen @ _OF_BYTE
    return classes, int(seen @ _IS_SYMBOL), int(classes.sum() - classes[3])


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more, the first occurrence included."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    total, covered = 0, 0  # covered: words before this index are counted
    for i, window in enumerate(windows):
        if counts[window] > 1:
            total += i + 3 - max(i, covered)
            covered = i + 3
    return total


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> float:
    """Divergence of two histograms, base 2 (the distance is its root); 0 if one is empty."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2

    def part(x: np.ndarray) -> float:
        at = x > 0
        return float((x[at] * np.log2(x[at] / m[at])).sum())

    return max(0.0, (part(p) + part(q)) / 2)


# Above this expected count a class's part is taken from its normal limit.
_NORMAL = 50.0
_DRAWS = np.arange(int(_NORMAL + 10 * _NORMAL**0.5))
_LOG_FACTORIALS = np.array([math.lgamma(k + 1) for k in _DRAWS])


def chance(reference: np.ndarray, draws: float) -> tuple[float, float]:
    """Mean and standard deviation of the divergence of ``draws`` independent draws from ``reference``.

    Each class's count is Poisson; its part of the divergence is summed over the counts it may have.
    """
    q = reference[reference > 0] / reference.sum()
    many = q * draws > _NORMAL
    # A frequent class adds a chi-squared part: the square of a standard normal over 8 n ln 2.
    unit = 1 / (8 * draws * math.log(2))
    mean, variance = unit * many.sum(), 2 * unit**2 * many.sum()
    q = q[~many][:, None]
    if len(q):
        weight = np.exp(_DRAWS * np.log(q * draws) - q * draws - _LOG_FACTORIALS)
        p = _DRAWS / draws
        m = (p + q) / 2
        part = (np.where(p > 0, p * np.log2(np.maximum(p, 1e-300) / m), 0) + q * np.log2(q / m)) / 2
        means = (weight * part).sum(1)
        mean += means.sum()
        variance += ((weight * part**2).sum(1) - means**2).sum()
    return float(mean), float(max(variance, 0)) ** 0.5


@dataclass
class Reference:
    classes: np.ndarray
    index: dict[bytes, int]
    words: np.ndarray  # weights of the common words, then of all others
    limits: dict = field(default_factory=dict)

    def word_counts(self, words: Counter) -> np.ndarray:
        out = np.zeros(len(self.words), dtype=np.int64)
        for word, i in self.index.items():
            out[i] = words.get(word, 0)
        out[-1] = sum(words.values()) - out[:-1].sum()
        return out

    def limit(self, of_words: bool, words: int) -> float:
        """The divergence allowed to a document of so many words; lengths are rounded down in steps of a fifth octave."""
        step = int(5 * math.log2(words))
        if (of_words, step) not in self.limits:
            draws = 2 ** (step / 5)
            mean, spread = chance(self.words, draws) if of_words else chance(self.classes, draws / WORDS_PER_DRAW)
            allowance = WORD_ALLOWANCE if of_words else CLASS_ALLOWANCE
            self.limits[of_words, step] = mean + SPREADS * spread + allowance
        return self.limits[of_words, step]

    def packed(self) -> bytes:
        listed = [[w.hex() for w in self.index], self.words.tolist(), self.classes.tolist()]
        return zlib.compress(json.dumps(listed).encode(), 1)

    @classmethod
    def unpacked(cls, data: bytes) -> Reference:
        names, words, classes = json.loads(zlib.decompress(data))
        index = {bytes.fromhex(w): i for i, w in enumerate(names)}
        return cls(np.array(classes, np.int64), index, np.array(words, np.int64))


def near_key(text: bytes) -> int:
    """The least rolling hash of the lower-cased text: copies share it, and near copies nearly always."""
    data = np.frombuffer(text.translate(LOWER), np.uint8).astype(np.uint64) + np.uint64(1)
    factor, size = 0x9E3779B97F4A7C15, 1
    while size < _NEAR_BYTES:
        if len(data) <= size:
            return xxhash.xxh3_64_intdigest(text) - (1 << 63)
        data = data[:-size] * np.uint64(factor) + data[size:]
        factor, size = factor * factor % (1 << 64), 2 * size
    data = (data ^ (data >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return int(data.min()) - (1 << 63)


# A document's share of a reference is split into so many parts.
_WEIGHT = 1 << 20
_SKETCHES = "lang string, near long, whole long, words binary, counts binary, classes array<long>"


def _language() -> Column:
    """The join key of a language: null is a language too, and no text is its key."""
    return F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))


def _sketches(docs: DataFrame) -> DataFrame:
    """Per document that passes the base rules its words and classes, with what tells copies."""
    names = [c.split()[0] for c in _SKETCHES.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
            rows = []
            for lang, text in zip(langs, texts_of(batch), strict=True):
                words = words_of(text)
                if base_failed(len(words), repeated_words(words)):
                    continue
                counter = Counter(words_of(text.translate(LOWER)))
                counts = np.array(list(counter.values()), np.uint32).tobytes()
                packed = zlib.compress(b" ".join(counter), 1), zlib.compress(counts, 1)
                classes = class_counts(text)[0]
                shares = np.rint(classes * (_WEIGHT / classes.sum())).astype(np.int64).tolist()
                rows.append((lang, near_key(text), xxhash.xxh3_64_intdigest(text) - (1 << 63), *packed, shares))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return arrow_map(docs.select("lang", "text"), run, _SKETCHES)


_COUNTS = "lang string, word binary, class int, n long"
# Distinct words that a task counts before it passes them on; they are added up again after the shuffle.
_HELD_WORDS = 150_000


def _counts(sketches: DataFrame) -> DataFrame:
    """Partial sums by language of the weights of words (``class`` is null) and of classes (``word`` is null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, Counter] = {}
        classes: dict[str | None, np.ndarray] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, counter in held.items():
                size, extra = len(counter), len(CLASSES)
                columns = [
                    pa.array([lang] * (size + extra), pa.string()),
                    pa.array([*counter, *[None] * extra], pa.binary()),
                    pa.array([*[None] * size, *range(extra)], pa.int32()),
                    pa.array([*counter.values(), *classes[lang].tolist()], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "class", "n"])
            held.clear()
            classes.clear()

        for batch in batches:
            for row in batch.to_pylist():
                lang, words = row["lang"], zlib.decompress(row["words"]).split(b" ")
                counter = held.setdefault(lang, Counter())
                counts = np.frombuffer(zlib.decompress(row["counts"]), np.uint32)
                weights = np.rint(counts * (_WEIGHT / counts.sum())).astype(np.int64)
                for word, weight in zip(words, weights.tolist(), strict=True):
                    counter[word] += weight
                classes[lang] = classes.get(lang, 0) + np.array(row["classes"], np.int64)
            if sum(map(len, held.values())) > _HELD_WORDS:
                yield from rows()
        yield from rows()

    return arrow_map(sketches, run, _COUNTS)


def references(docs: DataFrame, common_words: int = COMMON_WORDS) -> DataFrame:
    """A row per language (``key``, see ``_language``) with its packed ``Reference``.

    Null is a language too. The most common words are found in 32 parts of each language's words
    first, so that no task sorts all words of a language.
    """
    sketch = F.struct("whole", "words", "counts", "classes")
    single = _sketches(docs).groupBy("lang", "near").agg(F.min(sketch).alias("s"))
    counted = _counts(single.select("lang", "s.words", "s.counts", "s.classes"))
    counted = written(counted.groupBy("lang", "word", "class").agg(F.sum("n").alias("n")), "word_counts")
    words = counted.filter("word is not null").withColumn("part", F.pmod(F.xxhash64("word"), F.lit(32)))
    order = [F.desc("n"), F.asc("word")]
    top = words.withColumn("r", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order))).filter(F.col("r") <= common_words)
    top = top.withColumn("r", F.row_number().over(W.partitionBy("lang").orderBy(*order))).filter(F.col("r") <= common_words)
    listed = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("r", "word", "n"))).alias("top"))
    classes = counted.filter("word is null").groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("class", "n"))).alias("classes"))
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    rows = [f.select(_language().alias("key"), *[c for c in f.columns if c != "lang"]) for f in (totals, listed, classes)]
    joined = rows[0].join(rows[1], "key").join(rows[2], "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for row in batch.to_pylist():
                weights = [w["n"] for w in row["top"]]
                index = {bytes(w["word"]): i for i, w in enumerate(row["top"])}
                classes = np.array([c["n"] for c in row["classes"]], np.int64)
                packed.append(Reference(classes, index, np.array([*weights, row["total"] - sum(weights)], np.int64)).packed())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["key", "reference"])

    return written(arrow_map(joined, run, "key string, reference binary"), "references")


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


@dataclass
class Measures:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    class_distance: float | None = None  # None: too short to judge, or no document of the language passes the base rules
    class_limit: float | None = None
    word_distance: float | None = None
    word_limit: float | None = None

    @property
    def base_failed(self) -> bool:
        return base_failed(self.n_words, self.n_repeat_words)

    @property
    def kept(self) -> bool:
        pairs = ((self.class_distance, self.class_limit), (self.word_distance, self.word_limit))
        return not self.base_failed and all(d is None or d <= limit for d, limit in pairs)


def measure(text: bytes, reference: Reference | None) -> Measures:
    words = words_of(text)
    classes, symbols, chars = class_counts(text)
    found = Measures(len(words), chars, symbols, duplicate_lines(text), repeated_words(words))
    if reference is None or not words:
        return found
    if chars >= MIN_CLASS_CHARS:
        found.class_distance = jensen_shannon(classes, reference.classes) ** 0.5
        found.class_limit = reference.limit(False, len(words)) ** 0.5
    if len(words) >= MIN_COMMON_WORDS:
        counts = reference.word_counts(Counter(words_of(text.translate(LOWER))))
        found.word_distance = jensen_shannon(counts, reference.words) ** 0.5
        found.word_limit = reference.limit(True, len(words)) ** 0.5
    return found


# References a worker keeps unpacked.
_KEPT_REFERENCES = 1000


def _map(docs: DataFrame, schema, make) -> DataFrame:
    """``make(batch, measures)`` for each batch of documents (``text``, ``lang``, no unknown names) joined to their language's reference."""
    joined = lookup_join(docs.withColumn("key", _language()), references(docs), ["key"], "left").drop("key")
    own = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacked: dict[bytes | None, Reference | None] = {None: None}
        for batch in batches:
            found = []
            for data, text in zip(batch.column(batch.schema.get_field_index("reference")).to_pylist(), texts_of(batch), strict=True):
                if data not in unpacked:
                    if len(unpacked) > _KEPT_REFERENCES:
                        unpacked = {None: None}
                    unpacked[data] = Reference.unpacked(data)
                found.append(measure(text, unpacked[data]))
            yield make(batch.select(own), found)

    return arrow_map(joined, run, schema)


SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        *[T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        *[T.StructField(n, T.DoubleType()) for n in ("class_distance", "class_limit", "word_distance", "word_limit")],
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType()),
    ]
)


def judge(docs: DataFrame) -> DataFrame:
    """One row of measures and the verdict per row of ``docs`` (``doc_id``, ``text``, ``lang``).

    Null texts are empty; rows without words fail the base rules. Repeated rows stay rows. The distances and
    their limits are null where the text is too short to be compared, or no document of its language passes the
    base rules. A null language is a language of its own, as is the empty one. An empty table gives no rows.
    """
    names = [f.name for f in SCHEMA.fields]

    def make(batch: pa.RecordBatch, found: list[Measures]) -> pa.RecordBatch:
        ids = batch.column(batch.schema.get_field_index("doc_id")).cast(pa.int64())
        kinds = [pa.int64()] * 5 + [pa.float64()] * 4 + [pa.bool_()] * 2
        columns = [pa.array([getattr(m, n) for m in found], k) for n, k in zip(names[1:], kinds, strict=True)]
        return pa.RecordBatch.from_arrays([ids, *columns], names=names)

    return _map(docs.select("doc_id", "text", "lang"), SCHEMA, make)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the verdict ``kept``, with their columns as they are."""

    def make(batch: pa.RecordBatch, found: list[Measures]) -> pa.RecordBatch:
        return batch.filter(pa.array([m.kept for m in found], pa.bool_()))

    plain = sealed(docs).withColumn("lang", F.col("_row.lang"))
    return opened(_map(plain, plain.schema, make), docs)
