"""Chat formatting by incremental rendering of a template that is a black box.

A template is a function from turns to text. Successive prefixes of a conversation are rendered and
each output is compared with the one before: what is new is the turn's span, and an output that does not
begin with the one before shows that the template rewrites history. Two probe texts in place of the turn's
own show where its content begins and ends.

Nothing depends on a conversation's length. Of a template that promises nothing every prefix is rendered from
the first turn on, for which a task holds one conversation and takes time by the square of its turns. A template may
promise with ``local(k)`` that what a turn adds depends on the k turns before it: every turn is then rendered after
exactly those, conversations stream through a task turn by turn in linear time, and a turn that adds anything else after
k + 1 turns, or rewrites them, ends the query with an error.

Conversations are written in parts of bounded size.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir
from .common import arrow_map

Turn = tuple[str, str]  # role and text
Template = Callable[[list[Turn]], str]

_START, _END = "<|im_start|>", "<|im_end|>"
# Beginnings of control strings of common chat templates; texts must not show them.
_CONTROL = re.compile(r"<(?=\|)|<(?=/?s>)|\[(?=/?INST\])|<(?=</?SYS>>)|\|(?=>)")
_TURN = re.compile(re.escape(_START) + r"([^\n]*)\n(.*?)" + re.escape(_END) + "\n", re.DOTALL)
TRAINED_ROLE = "assistant"
# The size of a written part.
PART_TURNS = 4096
PART_CHARS = 8_000_000


def escape(text: str) -> str:
    """Backslashes are doubled; a single one then parts each control string after its first character."""
    return _CONTROL.sub(lambda m: m[0] + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def local(context: int) -> Callable[[Template], Template]:
    """Declares that what a turn adds to a template's text depends on the ``context`` turns before it only."""

    def promised(template: Template) -> Template:
        template.context = context
        return template

    return promised


def _context(template: Template) -> int | None:
    return getattr(template, "context", None)


@local(0)
def marked_turns(turns: list[Turn]) -> str:
    """The template of the query: each turn between a start mark with its role and an end mark."""
    return "".join(f"{_START}{quote(role, safe='')}\n{escape(text)}{_END}\n" for role, text in turns)


def parse(formatted: str) -> list[Turn]:
    """Turns of a text that :func:`marked_turns` made."""
    turns, at = [], 0
    for found in _TURN.finditer(formatted):
        if found.start() != at:
            raise ValueError(f"no turn at {at}")
        turns.append((unquote(found[1]), unescape(found[2])))
        at = found.end()
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")
    return turns


@dataclass
class Rendered:
    text: str
    spans: list[tuple[int, int]]  # of each turn
    contents: list[tuple[int, int]]  # of each turn's text inside its span
    rewrites: int | None  # first turn whose rendering changed what was before


def _common(a: str, b: str) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _content(template: Template, before: list[Turn], role: str, known: int, new: str) -> tuple[int, int]:
    """Where the turn's text lies in what the turn added, shown by two texts that differ in every letter."""
    a, b = (template([*before, (role, probe)])[known:] for probe in ("a", "b"))
    head = _common(a, b)
    tail = len(a) - head - 1
    return head, max(head, len(new) - tail)


def _from(template: Template, before: list[Turn], turns: list[Turn]) -> tuple[list[str], list[tuple[int, int]], int | None]:
    """What each turn adds after ``before``, the places of contents in it, and the first turn that rewrote history."""
    seen, last = list(before), template(before)
    added, places, rewrites = [], [], None
    for i, (role, text) in enumerate(turns):
        out = template([*seen, (role, text)])
        if rewrites is None and not out.startswith(last):
            rewrites = i
        same = len(last) if rewrites is None else _common(out, last)
        added.append(out[same:])
        places.append(_content(template, seen, role, same, added[-1]))
        seen.append((role, text))
        last = out
    return added, places, rewrites


def _added(template: Template, turns: list[Turn], first: int, context: int) -> tuple[list[str], list[tuple[int, int]]]:
    """What each turn from ``first`` on adds after its context, and the places of contents in it."""
    added, places = [], []
    for i in range(first, len(turns)):
        (new,), (place,), rewrites = _from(template, turns[max(0, i - context) : i], turns[i : i + 1])
        if i > context:  # one turn more must change nothing
            (more,), _, rewrites_more = _from(template, turns[i - context - 1 : i], turns[i : i + 1])
            rewrites = rewrites_more if rewrites is None else rewrites
        if rewrites is not None or (i > context and more != new):
            raise ValueError(f"the template depends on more than the {context} turns before a turn")
        added.append(new)
        places.append(place)
    return added, places


def render(template: Template, turns: list[Turn], before: list[Turn] | None = None) -> Rendered:
    """Render ``turns`` after the turns ``before`` (whose own text is not returned)."""
    before, context = before or [], _context(template)
    if context is None:
        added, places, rewrites = _from(template, before, turns)
        if rewrites is not None:
            return _rewritten(template, before, turns, rewrites)
    else:
        added, places = _added(template, before + turns, len(before), context)
    spans, contents, at = [], [], 0
    for text, (start, end) in zip(added, places, strict=True):
        spans.append((at, at + len(text)))
        contents.append((at + start, at + end))
        at += len(text)
    return Rendered("".join(added), spans, contents, None)


def _rewritten(template: Template, before: list[Turn], turns: list[Turn], first: int) -> Rendered:
    """A template that rewrites history has no spans that hold for all prefixes: none are claimed."""
    return Rendered(template(before + turns)[len(template(before)) :], [], [], first)


_PARTS = (
    "conv_id long, part int, last boolean, formatted string, n_turns long, rewrites int,"
    " mask array<struct<start: long, end: long>>"
)
_PART_TYPES = [
    pa.int64(), pa.int32(), pa.bool_(), pa.string(), pa.int64(), pa.int32(),
    pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
]
_PART_NAMES = ["conv_id", "part", "last", "formatted", "n_turns", "rewrites", "mask"]


def format_conversations(turns: DataFrame, template: Template = marked_turns, trained: str = TRAINED_ROLE) -> DataFrame:
    """Formatted parts of each conversation with the loss mask: the contents of the trained role's turns.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns are ignored. Turns are
    ordered by ``turn`` (null first), ties by role and text; repeated rows are turns of their own. Null roles
    and texts are empty, null ids are one conversation. Parts together are the whole conversation's rendering,
    wherever they are cut. If a template rewrites history, the first part holds the whole text. An empty table
    has no parts.
    """
    plain = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = plain.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = _context(template)
        current, part, chars, held, before = None, 0, 0, [], []
        out: list[tuple] = []
        cuts: list[int] = []  # turns before each part, where a conversation is rendered at its end

        def add(last: bool, text: str, rewrites: int | None, contents: list[tuple[int, int]], own: list[Turn]) -> None:
            nonlocal part
            mask = [{"start": s, "end": e} for (s, e), (role, _) in zip(contents, own, strict=False) if role == trained]
            out.append((current[0], part, last, text, len(own), rewrites, mask))
            part += 1

        def close(last: bool) -> None:
            nonlocal chars, held, before
            chars = 0
            if context is None and not last:
                cuts.append(len(held))
                return
            done = render(template, held, before)
            if cuts and done.rewrites is None:
                for low, high in zip([0, *cuts], [*cuts, len(held)], strict=True):
                    start, end = done.spans[low][0], done.spans[high - 1][1]
                    contents = [(a - start, b - start) for a, b in done.contents[low:high]]
                    add(high == len(held), done.text[start:end], None, contents, held[low:high])
            else:
                add(last, done.text, done.rewrites, done.contents, held)
            before = (before + held)[-(context + 1) :] if context is not None and not last else []
            held = []
            cuts.clear()

        def flushed() -> pa.RecordBatch:
            columns = [pa.array(v, k) for v, k in zip(zip(*out, strict=True), _PART_TYPES, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=_PART_NAMES)

        for batch in batches:
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                if current is not None and current[0] != conv:
                    close(True)
                    current, part = None, 0
                elif len(held) - (cuts[-1] if cuts else 0) >= PART_TURNS or chars >= PART_CHARS:
                    close(False)
                current = (conv,)
                held.append((role, text))
                chars += len(text)
            if out:
                yield flushed()
        if current is not None:
            close(True)
            yield flushed()

    return arrow_map(ordered, run, _PARTS)


class _Digest:
    """Digests over the parts of a conversation in order."""

    def __init__(self, conv: int | None):
        self.conv, self.n_turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, mask: list[dict]) -> None:
        for role, text in parse(formatted):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        for span in mask:
            text = unescape(formatted[span["start"] : span["end"]])
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        self.chars += len(formatted)

    def row(self) -> tuple:
        return (self.conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


_REPORT = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_REPORT_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
_REPORT_NAMES = [c.split()[0] for c in _REPORT.split(", ")]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by conversation and part."""
    current: _Digest | None = None
    for batch in batches:
        rows: list[tuple] = []
        for part in batch.to_pylist():
            if part["part"] == 0:
                if current:
                    rows.append(current.row())
                current = _Digest(part["conv_id"])
            current.add(part["formatted"], part["mask"])
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(zip(*rows, strict=True), _REPORT_TYPES, strict=True)], names=_REPORT_NAMES
            )
    if current:
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip(current.row(), _REPORT_TYPES, strict=True)], names=_REPORT_NAMES
        )


def read_back(parts: DataFrame) -> DataFrame:
    """Per conversation what its formatted parts hold. Only conversations of several parts are shuffled."""
    columns = ["conv_id", "part", "formatted", "mask"]
    whole = parts.filter("part = 0 and last").select(*columns)
    split = parts.filter("part > 0 or not last").select(*columns)
    split = split.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return arrow_map(whole, _digests, _REPORT).unionByName(arrow_map(split, _digests, _REPORT))


def conversation_report(turns: DataFrame) -> DataFrame:
    """Format, write, and read back the written parts."""
    folder = shared_dir(turns.sparkSession, "chat")
    format_conversations(turns).write.parquet(folder)
    return read_back(turns.sparkSession.read.parquet(folder))
