"""Removal of repeated byte strings by prefix-free parsing.

A byte goes if a string of ``LENGTH`` bytes that starts somewhere else too covers it, in any document. Strings
are judged on the input, and matches never cross documents.

Parsing: a rolling hash of ``TRIGGER`` bytes is taken at every position; the trigger of a string is where the
hash is least (the first of equal ones) within its first ``REACH`` positions. Equal strings have equal
triggers, and the strings of one trigger are a phrase: their starts are neighbours. A text position is thus its phrase's
suffix before the trigger and the parse's suffix from the trigger on, which is how the suffix order of the
dictionary and that of the parse combine into the order of the corpus.

1. The parse's suffixes are sorted by the bytes all strings of a phrase share after the trigger (hashed), then
   by all bytes the phrase's strings cover (hashed). A range sort splits a hot key. Neighbours tell the rest: whoever
   has no neighbour with the same shared bytes repeats nothing, whoever has one with the same covered bytes repeats
   with all its strings. Copies, the bulk of what repeats, end here.
2. Phrases that share only the bytes after the trigger fetch their bytes from the texts. Groups of at most
   ``GROUP`` of them are solved in a task: the suffixes after the trigger are sorted (the parse's suffix array), the
   parts before it are sorted from the trigger backwards (the dictionary's), and for every phrase suffix the
   occurrences are put in order of both; strings repeat where neighbours have all ``LENGTH`` bytes in common.
3. Larger groups, as of a passage in countless contexts, spread over all tasks: each of their strings is hashed
   and counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import lookup_join, written
from .common import arrow_map, texts_of

LENGTH = 200
TRIGGER, REACH = 8, 128
# Bytes after the trigger that all strings of a phrase have.
SHARED = LENGTH - REACH + 1
# Phrases with the same shared bytes that one task solves, and those it solves at once.
GROUP, AT_ONCE = 4096, 16384
# Positions hashed at once, and rows of a batch of hashes.
_CHUNK, _ROWS = 1 << 16, 50_000
_BASE, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9)


def _triggers(data: np.ndarray) -> np.ndarray:
    """For each position its trigger's; positions whose reach ends beyond the data are left out."""
    h, size, factor = data.astype(np.uint64) + np.uint64(1), 1, _BASE
    while size < TRIGGER:
        h = h[:-size] * np.uint64(factor) + h[size:]
        factor, size = factor * factor % (1 << 64), 2 * size
    h = (h ^ (h >> np.uint64(29))) * _MIX
    h &= np.uint64(0xFFFFFFFF00000000)
    h |= np.arange(len(h), dtype=np.uint64)
    size = 1
    while size < REACH:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return (h & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _phrases(blob: bytes, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """First and last string start and the trigger of all phrases, a chunk at a time.

    ``ends`` are the documents' ends in ``blob``; a string lies in one document.
    """
    data = np.frombuffer(blob, np.uint8)
    step = REACH + TRIGGER
    starts = np.concatenate([[0], ends[:-1]])
    low, size = 0, len(data)
    while low + LENGTH <= size:
        high = min(low + _CHUNK, size - LENGTH + 1)
        at = np.arange(low, high)
        doc = np.searchsorted(ends, at, side="right")
        at = at[at + LENGTH <= ends[doc]]
        if not len(at):
            # No string starts here; go to the next document that is long enough.
            later = np.flatnonzero((ends - starts >= LENGTH) & (starts >= high))
            low = int(starts[later[0]]) if len(later) else size
            continue
        trigger = _triggers(data[at[0] : at[-1] + step])[at - at[0]] + at[0]
        new = np.flatnonzero(np.concatenate([[True], trigger[1:] != trigger[:-1]]))
        first, last = at[new], at[np.concatenate([new[1:] - 1, [len(at) - 1]])]
        low = high
        if high < size - LENGTH + 1 and at[-1] == high - 1:  # the last phrase may go on
            low = int(first[-1])
            if len(new) == 1:
                raise ValueError("a phrase is longer than a chunk")
            first, last, new = first[:-1], last[:-1], new[:-1]
        if len(new):
            yield first, last, trigger[new]


def _hashes(parts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, parts)), np.int64)


def _identity(doc: int | None, text: bytes) -> bytes:
    """128 bits of a row's id and text."""
    return xxhash.xxh3_128_digest(b"%s\0%s" % (str(doc).encode(), text))


def _longs(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)


_PARSE = "key long, covered long, high long, low long, place long"


def parse(docs: DataFrame) -> DataFrame:
    """A row per phrase occurrence: hashes of the bytes shared after its trigger and of all it covers, and where it is.

    ``high`` and ``low`` are the document's identity; ``place`` holds the trigger's offset and how far before it the
    phrase's first and last string start (16, 8 and 8 bits from the right: see ``_unplaced``).
    """
    names = [c.split()[0] for c in _PARSE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            ids = _longs([_identity(d, t) for d, t in zip(batch.column(0).to_pylist(), texts, strict=True)])
            blob, ends = b"".join(texts), np.cumsum([len(t) for t in texts])
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            for first, last, trigger in _phrases(blob, ends):
                doc = np.searchsorted(ends, first, side="right")
                key = _hashes([blob[t : t + SHARED] for t in trigger.tolist()])
                covered = _hashes([blob[f:e] for f, e in zip(first.tolist(), (last + LENGTH).tolist(), strict=True)])
                place = (trigger - starts[doc]) << 16 | (trigger - first) << 8 | (trigger - last)
                columns = [key, covered, ids[doc, 0], ids[doc, 1], place]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, _PARSE)


def _unplaced(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The trigger's offset, and how far before it the first and the last string start."""
    return place >> 16, place >> 8 & 255, place & 255


# What a place is: an interval of repeated bytes, a phrase to be solved, or one that repeats and stands for its equals.
_SURE, _OPEN, _STANDS = 0, 1, 2
_FOUND = "high long, low long, start long, stop long, kind int"


class _Neighbours:
    """Streams the sorted parse and tells each row's kind from the rows before and after it.

    The ends of a range have an unknown neighbour, which may share anything: rows there count as open,
    and a run of equals that touches an end sends a representative.
    """

    def __init__(self) -> None:
        self.rows: np.ndarray | None = None  # the last row, whose follower is not known yet
        self.key_before = self.covered_before = False
        self.run_shares = False  # the run of equals that is open has a neighbour with its key before it

    def _kinds(self, rows: np.ndarray, last: bool) -> list[np.ndarray]:
        """``rows`` begins with the row kept; unless ``last`` its final row is kept for the next call."""
        first = self.rows is None
        same_key = rows[1:, 0] == rows[:-1, 0]
        same = same_key & (rows[1:, 1] == rows[:-1, 1])
        key_before = np.concatenate([[first or self.key_before], same_key])
        before = np.concatenate([[not first and self.covered_before], same])
        key_after, after = np.concatenate([same_key, [True]]), np.concatenate([same, [False]])
        count = len(rows) if last else len(rows) - 1
        begins = after & ~before
        at = np.maximum.accumulate(np.where(begins, np.arange(len(rows)), -1))
        shares = np.where(at >= 0, key_before[np.maximum(at, 0)], self.run_shares)
        sure = before | after
        ends = before & ~after
        stands = ends & (shares | key_after)
        is_open = ~sure & (key_before | key_after)
        if not last:
            self.rows = rows[-1:]
            self.key_before, self.covered_before = bool(key_before[-1]), bool(before[-1])
            self.run_shares = bool(shares[-1]) if before[-1] else False
        out = []
        done = rows[:count]
        trigger, far, near = _unplaced(done[:, 4])
        at_sure = np.flatnonzero(sure[:count])
        if len(at_sure):
            out.append(_intervals(done[at_sure], (trigger - far)[at_sure], (trigger - near)[at_sure] + LENGTH))
        for kind, chosen in ((_OPEN, is_open), (_STANDS, stands)):
            found = np.flatnonzero(chosen[:count])
            if len(found):
                part = done[found]
                out.append(np.column_stack([part[:, 2], part[:, 3], part[:, 4], np.zeros(len(found), np.int64), np.full(len(found), kind)]))
        return out

    def of(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.column_stack([batch.column(i).to_numpy() for i in range(5)])
            if not len(rows):
                continue
            rows = rows if self.rows is None else np.concatenate([self.rows, rows])
            if self.rows is None and len(rows) == 1:
                # A first row alone waits for its follower.
                self.rows, self.key_before, self.covered_before = rows, True, False
                continue
            yield from map(self._batch, self._kinds(rows, last=False))
        if self.rows is not None:
            yield from map(self._batch, self._kinds(self.rows, last=True))

    @staticmethod
    def _batch(rows: np.ndarray) -> pa.RecordBatch:
        names = [c.split()[0] for c in _FOUND.split(", ")]
        kinds = [pa.int64()] * 4 + [pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(rows[:, i], k) for i, k in enumerate(kinds)], names=names)


def _intervals(rows: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Intervals of repeated bytes; neighbours of one document that touch are one, as in runs of one character."""
    joins = (rows[1:, 2] == rows[:-1, 2]) & (rows[1:, 3] == rows[:-1, 3]) & (start[1:] >= start[:-1]) & (start[1:] <= stop[:-1])
    new = np.flatnonzero(np.concatenate([[True], ~joins]))
    last = np.concatenate([new[1:] - 1, [len(rows) - 1]])
    part = rows[new]
    return np.column_stack([part[:, 2], part[:, 3], start[new], stop[last], np.full(len(new), _SURE)])


def compared(parsed: DataFrame) -> DataFrame:
    """Sorted neighbours of the parse: intervals that repeat for sure, and phrases still to be solved (``start`` is their place)."""
    order = ["key", "covered", "high", "low", "place"]
    ordered = parsed.repartitionByRange(*order).sortWithinPartitions(*order)
    return arrow_map(ordered, lambda batches: _Neighbours().of(batches), _FOUND, rows=_ROWS)


_PACKED = "doc_id long, high long, low long, packed binary"


def packed(docs: DataFrame) -> DataFrame:
    """Texts compressed for the shuffle, with the identity of their row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = texts_of(batch)
            ids = _longs([_identity(d, t) for d, t in zip(batch.column(0).to_pylist(), texts, strict=True)])
            columns = [batch.column(0), pa.array(ids[:, 0]), pa.array(ids[:, 1]), pa.array([press.compress(t) for t in texts], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _PACKED.split(", ")])

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, _PACKED)


_CONTEXTS = "key long, high long, low long, place long, weight int, before binary, after binary"


def contexts(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The bytes around the triggers of phrases to be solved: ``before`` from the trigger backwards, ``after`` from it on.

    ``weight`` is 2 for a phrase that stands for its equals.
    """
    names = [c.split()[0] for c in _CONTEXTS.split(", ")]
    kinds = [pa.int64()] * 4 + [pa.int32(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in batch.to_pylist():
                text = unpress.decompress(row["packed"])
                for low in range(0, len(row["wanted"]), _ROWS):
                    wanted = row["wanted"][low : low + _ROWS]
                    place = np.array([w["start"] for w in wanted], np.int64)
                    trigger, far, near = (v.tolist() for v in _unplaced(place))
                    before = [text[t - f : t][::-1] for t, f in zip(trigger, far, strict=True)]
                    after = [text[t : t + LENGTH - n] for t, n in zip(trigger, near, strict=True)]
                    key = _hashes([a[:SHARED] for a in after])
                    same = [len(wanted)]
                    columns = [key, [row["high"]] * same[0], [row["low"]] * same[0], place, [max(w["kind"], 1) for w in wanted], before, after]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    wanted = found.filter(F.col("kind") != _SURE).groupBy("high", "low").agg(F.collect_list(F.struct("start", "kind")).alias("wanted"))
    # Both sides grow with the documents: they are always merged, never broadcast.
    joined = packed(docs).join(wanted.hint("merge"), ["high", "low"])
    return arrow_map(joined.select("high", "low", "packed", "wanted"), run, _CONTEXTS)


_SOLVED = "high long, low long, start long, stop long"


def _common(rows: np.ndarray, order: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Bytes that neighbours in ``order`` have in common from the left; -1 between groups."""
    differ = rows[order[1:]] != rows[order[:-1]]
    lcp = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return np.where(group[order[1:]] == group[order[:-1]], lcp, -1)


def _ranks(order: np.ndarray, lcp: np.ndarray, depth: int) -> np.ndarray:
    """Rank of each row's first ``depth`` bytes in its suffix array."""
    out = np.empty(len(order), np.int64)
    out[order] = np.concatenate([[0], np.cumsum(lcp < depth)])
    return out


def _padded(parts: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), np.uint8).reshape(len(parts), width)


def solve(group: np.ndarray, far: np.ndarray, near: np.ndarray, weight: np.ndarray, before: list[bytes], after: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For phrases of some groups the farthest and the nearest start before the trigger of a repeated string; -1: none.

    ``before`` and ``after`` are the bytes on both sides of the trigger, the former backwards. Padding sorts within
    its row's place and is not part of any string asked for.
    """
    left, right = _padded(before, REACH), _padded(after, LENGTH)
    listed = range(len(group))
    parse_order = np.array(sorted(listed, key=lambda i: (group[i], right[i].tobytes())), np.int64)
    dictionary_order = np.array(sorted(listed, key=lambda i: (group[i], left[i].tobytes())), np.int64)
    parse_lcp, dictionary_lcp = _common(right, parse_order, group), _common(left, dictionary_order, group)
    farthest, nearest = np.full(len(group), -1), np.full(len(group), -1)
    for offset in range(int(near.min()), int(far.max()) + 1):
        own = np.flatnonzero((near <= offset) & (offset <= far))
        if not len(own):
            continue
        # The corpus' order of the strings that start so far before a trigger: by phrase suffix, then by parse suffix.
        suffix = _ranks(dictionary_order, dictionary_lcp, offset)[own] * len(group) + _ranks(parse_order, parse_lcp, LENGTH - offset)[own]
        order = np.argsort(suffix, kind="stable")
        new = np.flatnonzero(np.concatenate([[True], suffix[order][1:] != suffix[order][:-1]]))
        counts = np.add.reduceat(weight[own][order], new)
        repeated = own[order][np.repeat(counts > 1, np.diff(np.concatenate([new, [len(own)]])))]
        farthest[repeated] = offset
        nearest[repeated] = np.where(nearest[repeated] < 0, offset, nearest[repeated])
    return farthest, nearest


def _solve_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Solves whole groups of a partition sorted by key, some at once."""

    def solved(table: pa.Table) -> pa.RecordBatch:
        place = table["place"].to_numpy()
        trigger, far, near = _unplaced(place)
        weight = table["weight"].to_numpy()
        farthest, nearest = solve(table["key"].to_numpy(), far, near, weight, table["before"].to_pylist(), table["after"].to_pylist())
        out = np.flatnonzero((farthest >= 0) & (weight == 1))
        columns = [table["high"].to_numpy()[out], table["low"].to_numpy()[out], (trigger - farthest)[out], (trigger - nearest)[out] + LENGTH]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["high", "low", "start", "stop"])

    held, count = [], 0
    for batch in batches:
        keys = batch.column(0).to_numpy()
        if held and count + len(keys) > AT_ONCE:
            # Groups end where the key changes; what is after the last change waits for more.
            table = pa.Table.from_batches([*held, batch])
            every = table["key"].to_numpy()
            cut = int(np.flatnonzero(every != every[-1])[-1]) + 1 if every[0] != every[-1] else 0
            if cut:
                yield solved(table.slice(0, cut))
            held = table.slice(cut).combine_chunks().to_batches()
            count = len(every) - cut
        else:
            held.append(batch)
            count += len(keys)
    if count:
        yield solved(pa.Table.from_batches(held))


_STRINGS = "first long, second long, high long, low long, trigger long, back int, weight int"


def _counted(rows: DataFrame) -> DataFrame:
    """Intervals of repeated strings in groups that are too large for a task: every string is hashed and counted."""
    names = [c.split()[0] for c in _STRINGS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                trigger, far, near = (int(v) for v in _unplaced(np.int64(row["place"])))
                text = row["before"][::-1] + row["after"]
                back = list(range(near, far + 1))
                halves = _longs([xxhash.xxh3_128_digest(text[far - o : far - o + LENGTH]) for o in back])
                same = len(back)
                columns = [halves[:, 0], halves[:, 1], [row["high"]] * same, [row["low"]] * same, [trigger] * same, back, [row["weight"]] * same]
                kinds = [pa.int64()] * 5 + [pa.int32()] * 2
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    strings = written(arrow_map(rows, run, _STRINGS), "strings")
    repeated = strings.groupBy("first", "second").agg(F.sum("weight").alias("n")).filter("n > 1").select("first", "second")
    ours = strings.filter("weight = 1").join(repeated.hint("merge"), ["first", "second"], "left_semi")
    return ours.groupBy("high", "low", "trigger").agg(
        (F.col("trigger") - F.max("back")).alias("start"), (F.col("trigger") - F.min("back") + LENGTH).alias("stop")
    ).select("high", "low", "start", "stop")


def repeats(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """Intervals of repeated bytes (``start``, ``stop``) of documents by their identity; intervals may overlap."""
    found = written(compared(parse(docs)), "compared")
    around = written(contexts(docs, found), "contexts")
    large = around.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > group).select("key")
    small_groups = lookup_join(around, large, ["key"], "left_anti").repartition("key").sortWithinPartitions("key")
    solved = written(arrow_map(small_groups, _solve_batches, _SOLVED, rows=GROUP), "solved")
    counted = written(_counted(lookup_join(around, large, ["key"], "left_semi")), "counted")
    sure = found.filter(F.col("kind") == _SURE).select("high", "low", "start", "stop")
    return sure.unionByName(solved).unionByName(counted)


def _merged(intervals: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs that the intervals cover."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted((i["start"], i["stop"]) for i in intervals):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], stop)
        else:
            out.append((start, stop))
    return out


_CUT = "doc_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary"


def cut_repeats(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): the removed runs and the ``kept`` bytes.

    ``kept`` is binary: a run may begin or end within a character. Null texts are empty. Texts shorter than a string
    stay whole. Rows with equal id and text are documents of their own, so all their strings repeat. Null
    ids are documents too. Further columns of ``docs`` have no part. An empty table gives no rows.
    """
    names = [c.split()[0] for c in ("doc_id", "n_bytes", "spans", "kept")]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            spans, kept, sizes = [], [], []
            for row in batch.select(["packed", "intervals"]).to_pylist():
                text, runs = unpress.decompress(row["packed"]), _merged(row["intervals"] or [])
                edges = [0, *[edge for run in runs for edge in run], len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                spans.append([{"start": a, "stop": b} for a, b in runs])
                sizes.append(len(text))
            columns = [batch.column(batch.schema.get_field_index("doc_id")), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    intervals = F.collect_list(F.struct("start", "stop")).alias("intervals")
    covered = repeats(docs, group).groupBy("high", "low").agg(intervals)
    joined = packed(docs).join(covered.hint("merge"), ["high", "low"], "left")
    return arrow_map(joined.select("doc_id", "packed", "intervals"), run, _CUT)


def repeat_report(docs: DataFrame) -> DataFrame:
    """Counts of removed bytes and runs, and a digest of what is left."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return cut_repeats(docs).select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
