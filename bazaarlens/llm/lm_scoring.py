"""Scoring documents with a unigram base and the gated recurrent model.

Documents are packed into blocks of bounded size: the tokens as numbers of the block's own word list. A document's
id and text decide its block, so scores do not depend on how the table is laid out.
After that only word lists are shuffled by word, with one row per word and block, to count every training token
and to bring the counts back to the blocks that ask for them. The model starts from a short run on the first
block; then every block trains a copy on all its training documents, and the copies' weights are averaged in
the order of the blocks.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import written
from .common import LOWER, arrow_map, ship_code, texts_of, words_of
from .gated_lm import GatedModel, Lanes

# Bytes of text in a block, and outputs of the model (with those for the end and for all other words).
BLOCK_BYTES = 16 * 1024 * 1024
VOCABULARY = 1024
# The first run of the model sees this many tokens at most; it only gives the copies a common start.
START_TOKENS = 400_000
START_RATE, COPY_RATE = 0.01, 0.003
# Training lanes: one for each so many tokens, so that a small block makes enough updates too.
_LANE_TOKENS, _MIN_LANES, _MAX_LANES = 10_000, 16, 256
FOLDS, HELD_OUT_FOLD = 7, 2
# Tasks that average copies' weights, one copy in memory each.
_AVERAGERS = 16
_END = b""


def held_out(doc_id: int | None) -> bool:
    """By the id's decimal text; a null id has the empty text and is trained on."""
    text = "" if doc_id is None else str(doc_id)
    return zlib.crc32(text.encode()) % FOLDS == HELD_OUT_FOLD


class _Numbering(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


_BLOCKS = "block long, doc_ids array<long>, sizes binary, tokens binary, words binary, counts binary, n_words int"
_BLOCK_TYPES = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 4, pa.int32()]
_BLOCK_NAMES = [c.split()[0] for c in _BLOCKS.split(", ")]


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def pack(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of whole documents: word lists with training counts, and tokens as numbers of words; 0 is the end.

    Documents are spread by a hash of id and text over as many parts as the bytes of all texts ask for. A part is a
    block; one that repeated rows make twice as large is cut in the order of ids. Copies have ids of their own, so a
    hot text is spread too.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    total = docs.agg(F.sum(size.cast("long"))).first()[0] or 0
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.repartition(max(1, -(-total // block_bytes)), F.xxhash64("doc_id", "text")).sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, size = 0, 0
        ids: list[int | None] = []
        sizes, tokens, words = array("i"), array("i"), _Numbering({_END: 0})

        def closed() -> pa.RecordBatch:
            nonlocal number, size, ids, sizes, tokens, words
            own, flat = np.frombuffer(sizes, np.int32), np.frombuffer(tokens, np.int32)
            trained = np.repeat([not held_out(i) for i in ids], own)
            counts = np.bincount(flat[trained], minlength=len(words)).astype(np.int64)
            listed = zstandard.ZstdCompressor(level=1).compress(b"\n".join(list(words)[1:]))
            block = TaskContext.get().partitionId() << 24 | number
            row = [block, ids, _packed(own), _packed(flat), listed, _packed(counts), len(words)]
            number, size, ids = number + 1, 0, []
            sizes, tokens, words = array("i"), array("i"), _Numbering({_END: 0})
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, _BLOCK_TYPES, strict=True)], names=_BLOCK_NAMES
            )

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), texts_of(batch), strict=True):
                found = words_of(text.translate(LOWER))
                tokens.extend(map(words.__getitem__, found))
                tokens.append(0)
                sizes.append(len(found) + 1)
                ids.append(doc)
                size += len(text) + 1
                if size >= 2 * block_bytes:
                    yield closed()
        if ids:
            yield closed()

    return arrow_map(rows, run, _BLOCKS)


def _word_list(data: bytes, count: int) -> list[bytes]:
    words = zstandard.ZstdDecompressor().decompress(data).split(b"\n") if count > 1 else []
    return [_END, *words]


def word_rows(blocks: DataFrame) -> DataFrame:
    """``block``, ``at``, ``word`` and ``n`` (its training tokens in the block)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words = _word_list(row["words"], row["n_words"])
                counts = _unpacked(row["counts"], "i8")
                for at in range(0, len(words), 50_000):
                    part = words[at : at + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row["block"]] * len(part), pa.int64()),
                            pa.array(range(at, at + len(part)), pa.int32()),
                            pa.array(part, pa.binary()),
                            pa.array(counts[at : at + len(part)], pa.int64()),
                        ],
                        names=["block", "at", "word", "n"],
                    )

    return arrow_map(blocks.select("block", "words", "counts", "n_words"), run, "block long, at int, word binary, n long")


@dataclass
class Vocabulary:
    """The model's outputs from frequent to rare; every word that is not listed has the number ``other``."""

    numbers: dict[bytes, int]
    counts: np.ndarray
    other: int
    total: int  # training tokens
    distinct: int
    other_mass: int  # smoothed counts of all words that are not listed, and of unseen ones

    @classmethod
    def of(cls, counts: DataFrame, size: int = VOCABULARY) -> Vocabulary:
        sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
        known = counts.filter(F.col("c") > 0)
        ends = known.filter(F.col("word") == F.lit(_END)).collect()
        # The most frequent words of 64 parts first, so that what comes to the driver does not grow with the tasks.
        order = [F.desc("c"), F.asc("word")]
        part = known.filter(F.col("word") != F.lit(_END)).withColumn("part", F.pmod(F.xxhash64("word"), F.lit(64)))
        part = part.withColumn("r", F.row_number().over(W.partitionBy("part").orderBy(*order))).filter(F.col("r") <= size)
        rows = part.select("word", "c").orderBy(*order).limit(size - 2).collect()
        listed = {_END: ends[0]["c"] if ends else 0} | {bytes(r["word"]): r["c"] for r in rows}
        rest = sums["n"] - sum(listed.values())
        ranked = sorted([(-c, w) for w, c in listed.items()] + [(-rest, None)], key=lambda x: (x[0], x[1] or b""))
        numbers = {w: i for i, (_, w) in enumerate(ranked) if w is not None}
        other = next(i for i, (_, w) in enumerate(ranked) if w is None)
        mass = sums["n"] + sums["v"] + 1 - sum(c + 1 for w, c in listed.items() if c or w != _END)
        return cls(numbers, np.array([-c for c, _ in ranked]), other, sums["n"], sums["v"], mass)

    def map(self, words: list[bytes]) -> np.ndarray:
        return np.array([self.numbers.get(w, self.other) for w in words], dtype=np.int32)


def _train_block(row: dict, vocabulary: Vocabulary, model: GatedModel, rate: float, max_tokens: int | None) -> tuple[GatedModel, int]:
    sizes, flat = _unpacked(row["sizes"], "i4"), _unpacked(row["tokens"], "i4")
    kept = np.array([not held_out(i) for i in row["doc_ids"]], dtype=bool)
    if max_tokens is not None:
        kept &= np.cumsum(np.where(kept, sizes, 0)) <= max_tokens
    tokens = vocabulary.map(_word_list(row["words"], row["n_words"]))[flat[np.repeat(kept, sizes)]]
    copy = GatedModel(model.starts, dict(model.weights))
    lanes = min(_MAX_LANES, max(_MIN_LANES, len(tokens) // _LANE_TOKENS))
    copy.train(Lanes.of(tokens, sizes[kept].astype(np.int64), vocabulary.numbers[_END], lanes), rate=rate)
    return copy, len(tokens)


_COPIES = "block long, weights binary, tokens long"


def _flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[name].reshape(-1) for name in sorted(weights)]).astype(np.float64)


def _shaped(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name in sorted(like):
        size = like[name].size
        out[name] = flat[at : at + size].reshape(like[name].shape).astype(np.float32)
        at += size
    return out


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row: the mean weights by trained tokens. One copy is held at a time."""
    total, count, first = None, 0, None
    for batch in batches:
        for row in batch.to_pylist():
            first = row["block"] if first is None else first
            if row["tokens"]:
                part = np.frombuffer(row["weights"], "f8") * row["tokens"]
                total = part if total is None else total + part
                count += row["tokens"]
    if total is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([first], pa.int64()), pa.array([(total / count).tobytes()], pa.binary()), pa.array([count], pa.int64())],
            names=["block", "weights", "tokens"],
        )


def _trained(
    blocks: DataFrame, vocabulary: Vocabulary, model: GatedModel, rate: float, max_tokens: int | None = None
) -> GatedModel:
    """The mean of copies of ``model`` that each block trained."""
    shared = blocks.sparkSession.sparkContext.broadcast((vocabulary, model.starts, model.weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, starts, weights = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                copy, count = _train_block(row, known, GatedModel(starts, weights), rate, max_tokens)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["block"]], pa.int64()),
                        pa.array([_flat(copy.weights).tobytes()], pa.binary()),
                        pa.array([count], pa.int64()),
                    ],
                    names=["block", "weights", "tokens"],
                )

    copies = arrow_map(blocks.select("block", "doc_ids", "sizes", "tokens", "words", "n_words"), run, _COPIES)
    # Sums depend on their order, which is that of the blocks.
    parted = copies.repartition(_AVERAGERS, "block").sortWithinPartitions("block")
    means = sorted(arrow_map(parted, _averaged, _COPIES).collect())  # 16 rows at most
    total = sum(m["tokens"] for m in means)
    if not total:
        return model
    mean = sum(np.frombuffer(m["weights"], "f8") * (m["tokens"] / total) for m in means)
    return GatedModel(model.starts, _shaped(mean, model.weights))


_SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)
_SCORE_TYPES = [pa.int64(), pa.bool_(), *[pa.int64()] * 3, *[pa.float64()] * 2]


def _score_block(row: dict, counts: np.ndarray, vocabulary: Vocabulary, model: GatedModel) -> list:
    sizes, flat = _unpacked(row["sizes"], "i4").astype(np.int64), _unpacked(row["tokens"], "i4")
    starts = np.cumsum(sizes) - sizes
    smoothed = np.log10(counts + 1.0)
    base = np.add.reduceat(smoothed[flat], starts) - sizes * np.log10(vocabulary.total + vocabulary.distinct + 1.0)
    known = np.add.reduceat((counts > 0).astype(np.int64)[flat], starts)
    numbers = vocabulary.map(_word_list(row["words"], row["n_words"]))
    tokens = numbers[flat]
    found = model.log_probabilities(Lanes.of(tokens, sizes, vocabulary.numbers[_END]), len(tokens)) / np.log(10)
    found += np.where(numbers == vocabulary.other, smoothed - np.log10(max(vocabulary.other_mass, 1)), 0.0)[flat]
    ids = row["doc_ids"]
    score = np.add.reduceat(found, starts)
    return [ids, [held_out(i) for i in ids], sizes, known, [vocabulary.total] * len(ids), base, score]


def score(docs: DataFrame, block_bytes: int = BLOCK_BYTES, vocabulary_size: int = VOCABULARY) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``) with the base's and the model's log10 probability.

    Null texts are empty and have the end as their only token. Repeated rows are documents of their own. If
    there is nothing to train on, the model is that of no counts. An empty table gives no rows.
    """
    spark = docs.sparkSession
    blocks = written(pack(docs, block_bytes), "blocks")
    words = word_rows(blocks)
    counts = written(words.groupBy("word").agg(F.sum("n").alias("c")), "token_counts")
    vocabulary = Vocabulary.of(counts, vocabulary_size)
    model = GatedModel.new(vocabulary.counts)
    first = blocks.filter(F.col("block") == F.lit(blocks.agg(F.min("block")).first()[0]))
    model = _trained(first, vocabulary, model, START_RATE, START_TOKENS)
    model = _trained(blocks, vocabulary, model, COPY_RATE)
    shared = spark.sparkContext.broadcast((vocabulary, model.starts, model.weights))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        known, starts, weights = shared.value
        (row,) = left.to_pylist()
        own = np.zeros(row["n_words"], dtype=np.int64)
        own[right["at"].to_numpy()] = right["c"].to_numpy()
        columns = _score_block(row, own, known, GatedModel(starts, weights))
        names = [c.split()[0] for c in _SCORES.split(", ")]
        return pa.Table.from_arrays([pa.array(v, k) for v, k in zip(columns, _SCORE_TYPES, strict=True)], names=names)

    ship_code(spark)
    # Few blocks to a task, whatever they weigh.
    tasks = 2 * max(1, blocks.count())
    asked = words.join(counts, "word").select("block", "at", "c").repartition(tasks, "block")
    packed = blocks.select("block", "doc_ids", "sizes", "tokens", "words", "n_words").repartition(tasks, "block")
    return packed.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(run, _SCORES)
