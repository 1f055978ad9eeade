"""Personal data: patterns, and a skip-chain conditional random field that adds what patterns miss.

The base finds four kinds of spans by pattern. The field labels the tokens of a document that hold a digit
or an @ (all others cannot be personal data of these kinds): neighbours share a chain potential, and each
token is also linked to the first token that is the same or similar (equal digits, or equal letters
and digits), however far away, so that any two equal tokens are two links apart. Loopy message passing over both,
until no message changes, makes labels agree across the document: a number that is a phone number where it is
written in full (the base's spans are given) is one where it is written short. The field is fitted
on pattern-labelled documents, while features are hidden at random so that links have to carry labels.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]  # kind, start, end (exclusive), in code points

# The base patterns.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_HINT = re.compile(r"[0-9@]")


def emails(text: str) -> Iterator[Span]:
    """Only places around an @ are tried: the local part ends there and cannot hold another one."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        free = domain.end() if domain else at + 1
        if domain:
            yield "email", start, free
        at = text.find("@", max(free, at + 1))


def addresses(text: str) -> Iterator[Span]:
    """In a run of numbers parted by dots, the pattern matches four numbers at a time from the left."""
    for run in _DOTTED.finditer(text):
        parts = run[0].split(".")
        at = run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield "ip", at, end
            at = end + 1


def _passes_luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for found in _CARD.finditer(text):
        digits = found[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _passes_luhn(digits):
            yield "card", found.start(), found.end()


def phones(text: str) -> Iterator[Span]:
    for found in _PHONE.finditer(text):
        if 9 <= len(_DIGIT.findall(found[0])) <= 15:
            yield "phone", found.start(), found.end()


def base_spans(text: str) -> list[Span]:
    """Spans by kind in the order of ``KINDS``, then by start."""
    out: list[Span] = []
    if "@" in text:
        out += emails(text)
    if _DIGIT.search(text):
        out += addresses(text)
        out += cards(text)
        if "+" in text:
            out += phones(text)
    return out


def _shape(token: str) -> list[float]:
    """What a token looks like; the patterns themselves are no features."""
    digits = sum(c.isdigit() for c in token)
    letters = sum(c.isalpha() for c in token)
    groups = [len(g) for g in re.findall(r"[0-9]+", token)]
    bins = (1, 3, 6, 9, 12, 19)
    return [
        1.0,
        "@" in token,
        "@" in token and "." in token.rpartition("@")[2],
        token.count(".") == 3 and not letters,
        token.count(".") in (1, 2) and not letters,
        token.startswith("+"),
        token.startswith("("),
        "-" in token and not letters,
        token.rstrip(".,;:!?").isdigit(),
        bool(letters and digits),
        "=" in token or '"' in token,
        len(groups) == 2 and groups == [3, 4],
        bool(groups) and max(groups) <= 3,
        *[digits <= b and (i == 0 or digits > bins[i - 1]) for i, b in enumerate(bins)],
        digits > bins[-1],
    ]


_SHAPES = len(_shape(""))


@dataclass
class Graph:
    """Tokens of many documents with the links between them."""

    shapes: list[list[float]] = field(default_factory=list)
    spans: list[tuple[int, int, int]] = field(default_factory=list)  # document, start, end
    chain: list[tuple[int, int]] = field(default_factory=list)
    skip: list[tuple[int, int]] = field(default_factory=list)

    def add(self, document: int, text: str) -> None:
        last_index, known = -2, {}
        for index, found in enumerate(re.finditer(r"\S+", text)):
            token = found[0]
            if not _HINT.search(token):
                continue
            me = len(self.spans)
            follows = last_index == index - 1
            self.shapes.append([*_shape(token), not follows])
            self.spans.append((document, found.start(), found.end()))
            if follows:
                self.chain.append((me - 1, me))
            digits = "".join(_DIGIT.findall(token))
            plain = re.sub(r"[\W_]+", "", token).lower()
            linked = {known.get(("d", digits)) if len(digits) > 3 else None, known.get(("t", plain))}
            for other in linked - {None}:
                self.skip.append((other, me))
            known.setdefault(("d", digits), me)
            known.setdefault(("t", plain), me)
            last_index = index

    def features(self) -> np.ndarray:
        return np.array(self.shapes, dtype=np.float64).reshape(len(self.shapes), _SHAPES + 1)


LABELS = len(KINDS) + 1  # 0: none
# Messages pass until none changes by more than the tolerance; the rounds only end loops that never settle.
_ROUNDS = 1000
_TOLERANCE = 1e-6
# Gradients need no settled messages.
_FIT_ROUNDS = 6
_DAMPING = 0.5
_SLOWER_AFTER = 100
_NEVER = -50.0


@dataclass
class SkipChainField:
    nodes: np.ndarray  # features x labels
    chain: np.ndarray  # labels x labels, left to right
    skip: np.ndarray  # labels x labels, symmetric

    def beliefs(
        self, features: np.ndarray, chain: np.ndarray, skip: np.ndarray, given: np.ndarray | None = None, rounds: int | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Marginals of nodes, chain links and skip links once the messages have settled; ``given`` labels above 0 are fixed."""
        unary = features @ self.nodes
        if given is not None:
            unary[given > 0] = np.where(np.arange(LABELS) == given[given > 0, None], 0.0, _NEVER)
        links = np.concatenate([chain, skip])
        potentials = np.concatenate([np.broadcast_to(self.chain, (len(chain), LABELS, LABELS)), np.broadcast_to(self.skip, (len(skip), LABELS, LABELS))])
        left, right = links[:, 0], links[:, 1]
        to_right = np.zeros((len(links), LABELS))
        to_left = np.zeros((len(links), LABELS))

        sums = unary.copy()
        active = np.arange(len(links))
        for done in range(rounds or _ROUNDS):
            if not len(active):
                break
            a, b, was_right, was_left = left[active], right[active], to_right[active], to_left[active]
            forward = _normal(_log_sum((sums[a] - was_left)[:, :, None] + potentials[active], 1))
            back = _normal(_log_sum((sums[b] - was_right)[:, None, :] + potentials[active], 2))
            step = 1 - _DAMPING if done < _SLOWER_AFTER else (1 - _DAMPING) / 5
            right_change, left_change = step * (forward - was_right), step * (back - was_left)
            to_right[active] += right_change
            to_left[active] += left_change
            np.add.at(sums, b, right_change)
            np.add.at(sums, a, left_change)
            # Only links at a node that moved have anything to pass on: settled parts rest.
            moved = np.zeros(len(sums), dtype=bool)
            moved[b[np.abs(right_change).max(axis=1) > _TOLERANCE]] = True
            moved[a[np.abs(left_change).max(axis=1) > _TOLERANCE]] = True
            active = np.flatnonzero(moved[left] | moved[right])
        pairs = (sums[left] - to_left)[:, :, None] + potentials + (sums[right] - to_right)[:, None, :]
        pairs = np.exp(pairs - pairs.max(axis=(1, 2), keepdims=True))
        pairs /= pairs.sum(axis=(1, 2), keepdims=True)
        return np.exp(_normal(sums)), pairs[: len(chain)], pairs[len(chain) :]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def _normal(x: np.ndarray) -> np.ndarray:
    return x - _log_sum(x, 1)[:, None] if len(x) else x


def _links(pairs: list[tuple[int, int]]) -> np.ndarray:
    return np.array(pairs, dtype=np.int64).reshape(-1, 2)


def gold_labels(graph: Graph, base: list[list[Span]]) -> np.ndarray:
    """Kind of the base span that a token overlaps; where kinds overlap the first listed counts."""
    labels = np.zeros(len(graph.spans), dtype=np.int64)
    # Spans of one kind are in order and do not overlap.
    sorted_spans = [[[(a, b) for k, a, b in spans if k == kind] for kind in KINDS] for spans in base]
    at = [[0] * len(KINDS) for _ in base]
    for i, (document, start, end) in enumerate(graph.spans):
        for label, spans in enumerate(sorted_spans[document]):
            k = at[document][label]
            while k < len(spans) and spans[k][1] <= start:
                k += 1
            at[document][label] = k
            if k < len(spans) and spans[k][0] < end and not labels[i]:
                labels[i] = label + 1
    return labels


HIDDEN_SHARE = 0.3
STEPS = 200


def fit(texts: list[str], steps: int = STEPS, seed: int = 7) -> SkipChainField:
    """Gradient ascent on the likelihood of the base's labels, with marginals from message passing."""
    graph = Graph()
    for i, text in enumerate(texts):
        graph.add(i, text)
    features, gold = graph.features(), gold_labels(graph, [base_spans(t) for t in texts])
    chain, skip = _links(graph.chain), _links(graph.skip)
    made = SkipChainField(np.zeros((_SHAPES + 1, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS)))
    if not len(features):
        made.nodes[0, 0] = 10.0
        return made
    random, hot = np.random.default_rng(seed), np.eye(LABELS)
    rate, speed, momentum = 0.1, {}, {}
    for step in range(1, steps + 1):
        hidden = features.copy()
        hidden[random.random(len(hidden)) < HIDDEN_SHARE, 1:_SHAPES] = 0
        node, pair, far = made.beliefs(hidden, chain, skip, rounds=_FIT_ROUNDS)
        slopes = {"nodes": hidden.T @ (hot[gold] - node)}
        for name, links, found in (("chain", chain, pair), ("skip", skip, far)):
            seen = np.einsum("ia,ib->ab", hot[gold[links[:, 0]]], hot[gold[links[:, 1]]]) - found.sum(axis=0)
            slopes[name] = (seen + seen.T) / 2 if name == "skip" else seen
        for name, slope in slopes.items():
            weights = getattr(made, name)
            slope = slope / len(features) - 1e-4 * weights
            momentum[name] = 0.9 * momentum.get(name, 0) + 0.1 * slope
            speed[name] = 0.99 * speed.get(name, 0) + 0.01 * slope**2
            change = momentum[name] / (1 - 0.9**step) / (np.sqrt(speed[name] / (1 - 0.99**step)) + 1e-8)
            setattr(made, name, weights + rate * change)
    return made


# An added span needs this marginal probability of its label on every token.
MIN_PROBABILITY = 0.9
_EDGES = ".,;:!?()[]{}<>\"'"


def added_spans(model: SkipChainField, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
    """Spans that the field labels and that touch no base span; neighbours of one kind are one span."""
    out: list[list[Span]] = [[] for _ in texts]
    graph = Graph()
    for i, text in enumerate(texts):
        if _HINT.search(text):
            graph.add(i, text)
    if not graph.spans:
        return out
    given = gold_labels(graph, base)
    found, _, _ = model.beliefs(graph.features(), _links(graph.chain), _links(graph.skip), given)
    best = np.where(found.max(axis=1) >= MIN_PROBABILITY, found.argmax(axis=1), 0)
    follows = {right for _, right in graph.chain}
    open_span: tuple[int, str, int, int] | None = None

    def close() -> None:
        if open_span:
            document, kind, start, end = open_span
            word = texts[document][start:end]
            start += len(word) - len(word.lstrip(_EDGES))
            end -= len(word) - len(word.rstrip(_EDGES))
            if start < end:
                out[document].append((kind, start, end))

    for i, (document, start, end) in enumerate(graph.spans):
        kind = KINDS[best[i] - 1] if best[i] and not given[i] else None
        if kind and open_span and i in follows and open_span[0] == document and open_span[1] == kind:
            open_span = (document, kind, open_span[2], end)
            continue
        close()
        open_span = (document, kind, start, end) if kind else None
    close()
    return out


# The field is fitted on this many documents with digits or an @, of at most so many characters.
FIT_DOCUMENTS = 1500
FIT_CHARS = 20_000


def fit_on(docs: DataFrame, documents: int = FIT_DOCUMENTS) -> SkipChainField:
    """Fit on a bounded sample, the rows with the smallest hashes, so that it does not depend on partitions."""
    hinted = docs.filter(F.col("text").rlike("[0-9@]") & (F.length("text") <= FIT_CHARS))
    count = hinted.count()
    if not count:
        return fit([])
    # Rows below this hash are about as many as are wanted, however many tasks there are.
    share = min(1.0, 1.2 * documents / count)
    cut = min(int(share * (1 << 64)) - (1 << 63), (1 << 63) - 1)
    marked = hinted.select("text", F.xxhash64("doc_id", "text").alias("h")).filter(F.col("h") <= cut)
    rows = marked.limit(2 * documents).collect()
    rows.sort(key=lambda row: (row["h"], row["text"]))
    return fit([row["text"] for row in rows[:documents]])


def joined(spans: list[Span]) -> str:
    """``kind:start:end``, by kind as listed, then start."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS],
        T.StructField("base_sha256", T.StringType()),
        T.StructField("spans", T.StringType()),
        T.StructField("n_added", T.LongType()),
    ]
)


def find_personal_data(docs: DataFrame, model: SkipChainField | None = None) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): the base's counts and digest, and all spans.

    Null texts are empty and have no spans. Repeated rows stay rows. Without ``model`` one is fitted on
    ``docs``; an empty table gives a field that labels nothing.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shared = docs.sparkSession.sparkContext.broadcast(model or fit_on(plain))
    names = [f.name for f in SCHEMA.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            base = [base_spans(t) for t in texts]
            added = added_spans(fitted, texts, base)
            counts = [[sum(s[0] == k for s in spans) for spans in base] for k in KINDS]
            columns = [
                batch.column(0),
                *[pa.array(c, pa.int64()) for c in counts],
                pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in base], pa.string()),
                pa.array([joined([*b, *a]) for b, a in zip(base, added, strict=True)], pa.string()),
                pa.array([len(a) for a in added], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return arrow_map(plain, run, SCHEMA)
