"""A gated recurrent language model in numpy: truncated backpropagation, class-factored output.

The state of a document starts at zero and is carried from window to window to its end, so a document's
score is its complete log-likelihood. Documents run side by side in lanes; a lane goes on with the next
document, whose first step forgets the state. A token's probability is that of its class times that of
the token within it, so an output costs about twice the square root of the vocabulary. Tokens outside
the vocabulary share one output, whose probability is divided among them by their smoothed counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

HIDDEN = 16
CLASSES = 32
WINDOW = 32
LANES = 512
RATE = 0.01
_CLIP = 1.0


def class_starts(counts: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """First index of each class when tokens, from frequent to rare, are cut into classes of equal square-root mass."""
    mass = np.cumsum(np.sqrt(np.maximum(counts, 1)))
    cuts = np.searchsorted(mass, np.arange(1, classes) * mass[-1] / classes, side="left") + 1
    return np.unique(np.concatenate([[0], cuts[cuts < len(counts)]])).astype(np.int64)


def _softmax_at(x: np.ndarray, at: np.ndarray, slopes: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Outputs x columns: the log-probability at ``at`` of each column and, with ``slopes``, its gradient by ``x``."""
    columns = np.arange(len(at))
    x -= x.max(axis=0)
    found = x[at, columns]
    np.exp(x, out=x)
    total = x.sum(axis=0)
    found = found - np.log(total)
    if not slopes:
        return found, None
    x *= -1 / total
    x[at, columns] += 1
    return found, x


@dataclass
class Lanes:
    """Tokens of documents laid side by side: steps x lanes."""

    inputs: np.ndarray
    targets: np.ndarray
    first: np.ndarray  # 0 where a document begins, else 1
    document: np.ndarray  # -1 beyond a lane's end
    place: np.ndarray  # index into the tokens
    lengths: np.ndarray  # steps of each lane, longest first

    @classmethod
    def of(cls, tokens: np.ndarray, sizes: np.ndarray, begin: int, lanes: int = LANES) -> Lanes:
        """``tokens`` of all documents in a row, ``sizes`` of each; ``begin`` is the input before a first token."""
        full = np.flatnonzero(sizes)
        lanes = max(1, min(lanes, len(full)))
        load, own = np.zeros(lanes, dtype=np.int64), [[] for _ in range(lanes)]
        for doc in full[np.argsort(-sizes[full], kind="stable")]:
            lane = int(load.argmin())
            own[lane].append(doc)
            load[lane] += sizes[doc]
        by_length = np.argsort(-load, kind="stable")
        load, own = load[by_length], [own[i] for i in by_length]
        steps = int(load[0]) if len(full) else 0
        place = np.full((steps, lanes), -1, dtype=np.int32)
        document = np.full((steps, lanes), -1, dtype=np.int32)
        starts = np.cumsum(sizes) - sizes
        for lane, docs in enumerate(own):
            at = 0
            for doc in docs:
                end = at + sizes[doc]
                place[at:end, lane] = np.arange(starts[doc], starts[doc] + sizes[doc])
                document[at:end, lane] = doc
                at = end
        first = np.ones((steps, lanes), dtype=np.float32)
        if steps:
            first[0] = 0
            first[1:][document[1:] != document[:-1]] = 0
        targets = np.full((steps, lanes), begin, dtype=np.int32)
        targets[place >= 0] = tokens[place[place >= 0]]
        inputs = np.full_like(targets, begin)
        if steps:
            inputs[1:] = np.where(first[1:] == 0, begin, targets[:-1])
        return cls(inputs, targets, first, document, place, load)

    def windows(self, size: int) -> Iterator[tuple[slice, int]]:
        """Steps of each window, and the lanes that reach into it."""
        for at in range(0, len(self.inputs), size):
            yield slice(at, at + size), int(np.searchsorted(-self.lengths, -at, side="left"))


@dataclass
class GatedModel:
    starts: np.ndarray  # first token of each class
    weights: dict[str, np.ndarray]
    moments: dict[str, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    updates: int = 0

    @classmethod
    def new(cls, counts: np.ndarray, hidden: int = HIDDEN, classes: int = CLASSES, seed: int = 5) -> GatedModel:
        """Untrained, the output is that of the counts (tokens from frequent to rare)."""
        random, size = np.random.default_rng(seed), len(counts)
        starts = class_starts(counts, classes)
        share = (counts + 1) / (counts + 1).sum()
        mass = np.add.reduceat(share, starts)
        in_class = share / np.repeat(mass, np.diff(np.append(starts, size)))

        def small(*shape: int) -> np.ndarray:
            return (random.standard_normal(shape) * 0.1).astype(np.float32)

        return cls(
            starts,
            {
                "gates": small(size, 3 * hidden),
                "carry": small(hidden, 3 * hidden),
                "to_class": small(hidden, len(starts)),
                "class_bias": np.log(mass).astype(np.float32),
                "to_word": small(hidden, size),
                "word_bias": np.log(in_class).astype(np.float32),
            },
        )

    def _run(self, inputs: np.ndarray, first: np.ndarray, state: np.ndarray, keep: list | None) -> np.ndarray:
        """States after each step; what backpropagation needs goes to ``keep``, steps first."""
        width, steps = state.shape[1], len(inputs)
        # A sigmoid is a tanh of half its input, so the halves are taken once for all steps.
        half = np.ones(3 * width, dtype=np.float32)
        half[: 2 * width] = 0.5
        carry, given = self.weights["carry"] * half, (self.weights["gates"] * half)[inputs]
        states = np.empty((steps, *state.shape), dtype=np.float32)
        befores, carries = np.empty_like(states), np.empty_like(given)
        gates, freshes = np.empty((steps, len(state), 2 * width), dtype=np.float32), np.empty_like(states)
        first = first[:, :, None]
        for t in range(steps):
            before, carried, gate, fresh = befores[t], carries[t], gates[t], freshes[t]
            np.multiply(state, first[t], out=before)
            np.matmul(before, carry, out=carried)
            np.add(given[t, :, : 2 * width], carried[:, : 2 * width], out=gate)
            np.tanh(gate, out=gate)
            gate *= 0.5
            gate += 0.5
            np.multiply(gate[:, width:], carried[:, 2 * width :], out=fresh)
            fresh += given[t, :, 2 * width :]
            np.tanh(fresh, out=fresh)
            state = states[t]
            np.subtract(before, fresh, out=state)
            state *= gate[:, :width]
            state += fresh
        if keep is not None:
            keep += [befores, gates[:, :, :width], gates[:, :, width:], freshes, carries[:, :, 2 * width :]]
        return states

    def _outputs(self, states: np.ndarray, targets: np.ndarray, slopes: dict | None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log-probability of each target and, with ``slopes``, the gradient of the states."""
        w, ends = self.weights, np.append(self.starts[1:], self.weights["word_bias"].shape[0])
        cls = np.searchsorted(self.starts, targets, side="right") - 1
        logits = w["to_class"].T @ states.T + w["class_bias"][:, None]
        logs, wrong = _softmax_at(logits, cls, slopes is not None)
        found, back = logs.astype(np.float64), None
        if slopes is not None:
            slopes["to_class"], slopes["class_bias"] = (wrong @ states).T, wrong.sum(axis=1)
            back = wrong.T @ w["to_class"].T
            slopes["to_word"], slopes["word_bias"] = np.zeros_like(w["to_word"]), np.zeros_like(w["word_bias"])
        order = np.argsort(cls.astype(np.int16), kind="stable")
        edges = np.searchsorted(cls[order], np.arange(len(self.starts) + 1))
        for c, (a, b) in enumerate(zip(self.starts, ends, strict=True)):
            own = order[edges[c] : edges[c + 1]]
            if b - a == 1 or not len(own):
                continue  # a class of one token: its probability within the class is 1
            here, part = states[own], w["to_word"][:, a:b]
            logs, wrong = _softmax_at(part.T @ here.T + w["word_bias"][a:b, None], targets[own] - a, slopes is not None)
            found[own] += logs
            if slopes is not None:
                slopes["to_word"][:, a:b], slopes["word_bias"][a:b] = (wrong @ here).T, wrong.sum(axis=1)
                back[own] += wrong.T @ part.T
        return found, back

    def log_probabilities(self, lanes: Lanes, count: int, window: int = WINDOW) -> np.ndarray:
        """Natural log-probability of each of ``count`` tokens, documents from their start to their end."""
        out = np.zeros(count)
        state = np.zeros((lanes.inputs.shape[1], self.weights["carry"].shape[0]), dtype=np.float32)
        for steps, count in lanes.windows(window):
            part = (steps, slice(count))
            states = self._run(lanes.inputs[part], lanes.first[part], state[:count], None)
            state = states[-1]
            real = lanes.place[part] >= 0
            out[lanes.place[part][real]] = self._outputs(states[real], lanes.targets[part][real], None)[0]
        return out

    def train(self, lanes: Lanes, window: int = WINDOW, rate: float = RATE) -> None:
        """One pass: the state is carried on, gradients end at a window's start."""
        state = np.zeros((lanes.inputs.shape[1], self.weights["carry"].shape[0]), dtype=np.float32)
        for steps, count in lanes.windows(window):
            part = (steps, slice(count))
            keep: list[np.ndarray] = []
            states = self._run(lanes.inputs[part], lanes.first[part], state[:count], keep)
            state = states[-1]
            real = lanes.place[part] >= 0
            slopes: dict[str, np.ndarray] = {}
            _, back = self._outputs(states[real], lanes.targets[part][real], slopes)
            error = np.zeros_like(states)
            error[real] = back
            self._back(lanes.inputs[part], lanes.first[part], keep, error, slopes)
            self._update(slopes, int(real.sum()), rate)

    def _back(self, inputs: np.ndarray, first: np.ndarray, keep: list, error: np.ndarray, slopes: dict) -> None:
        steps, lanes, width = error.shape
        before, update, reset, fresh, inner = keep
        # What a state's slope is multiplied with on its way to each gate: no step needs another one for it.
        to_fresh = (1 - update) * (1 - fresh * fresh)
        ways = np.empty((steps, lanes, 3, width), dtype=np.float32)
        ways[:, :, 0] = (before - fresh) * update * (1 - update)
        ways[:, :, 1] = to_fresh * inner * reset * (1 - reset)
        ways[:, :, 2] = to_fresh * reset
        back, first = np.ascontiguousarray(self.weights["carry"].T), first[:, :, None]
        carried, laters = np.empty_like(ways), np.empty_like(error)
        later = np.zeros_like(error[0])
        for t in range(steps - 1, -1, -1):
            here = laters[t]
            np.add(later, error[t], out=here)
            np.multiply(here[:, None, :], ways[t], out=carried[t])
            np.matmul(carried[t].reshape(lanes, 3 * width), back, out=later)
            later += here * update[t]
            later *= first[t]
        slopes["carry"] = before.reshape(-1, width).T @ carried.reshape(-1, 3 * width)
        carried[:, :, 2] = laters * to_fresh
        ids, given = inputs.reshape(-1), carried.reshape(-1, 3 * width)
        order = np.argsort(ids.astype(np.uint16) if len(self.weights["gates"]) <= 1 << 16 else ids, kind="stable")
        ids = ids[order]
        edges = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        slopes["gates"] = np.zeros_like(self.weights["gates"])
        slopes["gates"][ids[edges]] = np.add.reduceat(given[order], edges, axis=0)

    def _update(self, slopes: dict[str, np.ndarray], count: int, rate: float) -> None:
        if not count:
            return
        self.updates += 1
        size = np.sqrt(sum(float((s * s).sum()) for s in slopes.values())) / count
        scale = min(1.0, _CLIP / max(size, 1e-9)) / count
        for name, slope in slopes.items():
            slope = slope * np.float32(scale)
            if name not in self.moments:
                self.moments[name] = (np.zeros_like(slope), np.zeros_like(slope))
            mean, square = self.moments[name]
            mean *= 0.9
            mean += 0.1 * slope
            square *= 0.99
            slope *= slope
            square += 0.01 * slope
            size = np.sqrt(square / (1 - 0.99**self.updates))
            size += 1e-8
            # A copy: the weights a model starts from are shared.
            self.weights[name] = self.weights[name] - mean / size * np.float32(-rate / (1 - 0.9**self.updates))
