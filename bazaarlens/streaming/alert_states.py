"""The alert states of one label set, kept in the engine's keyed state.

A state holds the samples that later instants look back to, the last instant evaluated and the runs that are
open. Timers in event time bring it forward: whenever the watermark passes the next instant of the grid, all
instants up to it are evaluated and the changes go out. A label set without samples in reach and without an
open run has no state. This module imports nothing of the package: it is sent to executors by value.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

SECOND = 1_000_000
_TESTS = {"==": operator.eq, ">": operator.gt, "<": operator.lt, ">=": operator.ge, "<=": operator.le, "!=": operator.ne}
SAMPLE = "metric string, ts_us bigint, value double"
OPEN = "rule int, start_at bigint"


class Series:
    """Samples of one metric: of two at one time the larger counts."""

    def __init__(self, ts: np.ndarray, values: np.ndarray):
        order = np.lexsort((values, ts))
        ts, values = ts[order], values[order]
        last = np.append(ts[1:] != ts[:-1], True) if len(ts) else np.zeros(0, bool)
        self.ts, self.values = ts[last], values[last]

    def at(self, instants: np.ndarray, lookback: int) -> tuple[np.ndarray, np.ndarray]:
        """The newest value at instants (in microseconds), and whether there is one."""
        if not len(self.ts):
            return np.zeros(len(instants)), np.zeros(len(instants), bool)
        place = np.searchsorted(self.ts, instants, side="right") - 1
        newest = np.maximum(place, 0)
        return self.values[newest], (place >= 0) & (instants - self.ts[newest] <= lookback)

    def rate(self, instants: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """A counter's rate per second over the window before instants, extrapolated to its borders."""
        low = np.searchsorted(self.ts, instants - window, side="left")
        high = np.searchsorted(self.ts, instants, side="right")
        there = high - low > 1
        low, last = np.where(there, low, 0), np.where(there, high - 1, 0)
        if not there.any():
            return np.zeros(len(instants)), there
        drop = np.append(0.0, np.where(self.values[1:] < self.values[:-1], self.values[:-1], 0.0))
        lost = np.cumsum(drop)
        first = self.values[low]
        increase = self.values[last] - first + (lost[last] - lost[low])
        covered = (self.ts[last] - self.ts[low]).astype(float)
        with np.errstate(divide="ignore", invalid="ignore"):
            distance = covered / (last - low)
            head, tail = self.ts[low] - (instants - window), instants - self.ts[last]
            to_zero = covered * (first / increase)
            head = np.where((increase > 0) & (first >= 0) & (to_zero < head), to_zero, head)
            head = np.where(head >= distance * 1.1, distance / 2, head)
            tail = np.where(tail >= distance * 1.1, distance / 2, tail)
            rate = increase * ((covered + head + tail) / covered) / (window / SECOND)
        return np.where(there, rate, 0.0), there


def _selects(rule: dict, labels: dict[str, str | None]) -> bool:
    exact = all((labels.get(k) or "") == v for k, v in rule["labels"].items())
    return exact and all(re.fullmatch(p, labels.get(k) or "") for k, p in rule["patterns"].items())


def _holds(rule: dict, series: dict[str, Series], instants: np.ndarray, lookback: int) -> np.ndarray:
    """At which instants the rule's condition is true."""
    none = Series(np.zeros(0, np.int64), np.zeros(0))
    own = series.get(rule["metric"], none)
    if rule["window"]:
        values, there = own.rate(instants, rule["window"] * SECOND)
    else:
        values, there = own.at(instants, lookback)
        if rule["per"]:
            below, also = series.get(rule["per"], none).at(instants, lookback)
            there = there & also
            with np.errstate(divide="ignore", invalid="ignore"):
                # A denominator of either zero gives what zero gives.
                values = np.where(below == 0, np.where(values > 0, np.inf, np.where(values < 0, -np.inf, np.nan)), values / below)
    found = _TESTS[rule["op"]](values, rule["threshold"])
    return there & (found if rule["op"] == "!=" else found & ~np.isnan(values))


def changes(held: np.ndarray, first: int, start: int | None, hold: int, until: int) -> tuple[list[tuple[str, int]], int | None]:
    """State changes at instants ``first`` to ``until``, and the start of the run that is open then.

    ``held``: whether the condition holds from ``first`` on; behind its end it does not. ``start``: where a run
    began that is open before ``first``. ``hold``: instants until an alert fires.
    """
    whole = np.concatenate([[start is not None], held, [False]]).astype(np.int8)
    edges = np.flatnonzero(np.diff(whole))
    out: list[tuple[str, int]] = []
    for edge in edges:
        at = first + int(edge)
        if start is None:
            start = at
            if hold:
                out.append(("pending", at))
            continue
        if first <= start + hold < at:
            out.append(("firing", start + hold))
        if at > until:
            return out, start
        out.append(("resolved" if at - 1 >= start + hold else "inactive", at))
        start = None
    return out, start


class AlertStates(StatefulProcessor):
    """``rules``: dicts of a rule's fields; ``labels``: the names of the grouping columns, in order."""

    def __init__(self, rules: list[dict], labels: list[str], step: int, lookback: int, columns: list[str]):
        self.rules, self.labels, self.columns = rules, labels, columns
        self.step_us, self.lookback_us = step * SECOND, lookback * SECOND
        self.keep_us = max([lookback, *[r["window"] for r in rules if r["window"]]]) * SECOND
        self.metrics = {m for r in rules for m in (r["metric"], r["per"]) if m}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.samples = handle.getListState("samples", SAMPLE)
        self.done = handle.getValueState("done", "at bigint")
        self.open = handle.getListState("open", OPEN)

    def _wake(self, instant: int) -> None:
        """Be called once the watermark has passed an instant; the watermark is a millisecond behind the newest sample."""
        self.handle.registerTimer(max(1, instant * self.step_us // 1000 - 2))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for batch in rows:
            batch = batch[batch["metric"].isin(self.metrics) & batch["present"]]
            if len(batch):
                self.samples.appendList(list(zip(batch["metric"], batch["ts_us"].astype(int).tolist(), batch["value"].astype(float).tolist(), strict=True)))
                cell = -(-int(batch["ts_us"].min()) // self.step_us)
                first = cell if first is None else min(first, cell)
        if first is not None:
            self._wake(self.done.get()[0] + 1 if self.done.exists() else first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = (timerValues.getCurrentWatermarkInMs() + 1) * 1000 // self.step_us
        listed = [tuple(s) for s in self.samples.get()] if self.samples.exists() else []
        starts = {int(r[0]): int(r[1]) for r in self.open.get()} if self.open.exists() else {}
        ts = np.array([s[1] for s in listed], np.int64)
        cells = -(-ts // self.step_us)
        done = self.done.get()[0] if self.done.exists() else (int(cells.min()) - 1 if len(ts) else until)
        if until > done:
            # Beyond the reach of all samples nothing holds.
            reach = int((ts.max() + self.keep_us) // self.step_us) if len(ts) else done
            last = min(until, max(reach, done))
            instants = np.arange(done + 1, last + 1)
            out, kept = self._evaluated(key, listed, starts, instants, done + 1, until, last)
            done = until
            self.done.update((done,))
            self.open.clear()
            if kept:
                self.open.put(sorted(kept.items()))
            recent = [s for s in listed if s[1] >= done * self.step_us - self.keep_us]
            if len(recent) < len(listed):
                self.samples.clear()
                if recent:
                    self.samples.put(recent)
            if recent or kept:
                self._wake(done + 1)
            if out:
                yield pd.DataFrame(out, columns=self.columns)
        else:
            self._wake(done + 1)

    def _evaluated(self, key, listed, starts, instants, first, until, last) -> tuple[list[tuple], dict[int, int]]:
        labels = dict(zip(self.labels, key, strict=True))
        by_metric: dict[str, list] = {}
        for metric, ts, value in listed:
            by_metric.setdefault(metric, []).append((ts, value))
        series = {m: Series(*(np.array(c) for c in zip(*rows, strict=True))) for m, rows in by_metric.items()}
        out, kept = [], {}
        for number, rule in enumerate(self.rules):
            held = np.zeros(len(instants), bool)
            if _selects(rule, labels) and (rule["metric"] in series):
                held = _holds(rule, series, instants * self.step_us, self.lookback_us)
            if not held.any() and number not in starts:
                continue
            hold = -(-rule["hold"] * SECOND // self.step_us)
            # Runs that reach ``until`` are open; those that only reach the last sample's reach have ended.
            found, start = changes(held, first, starts.get(number), hold, until)
            out += [(rule["alertname"], rule["severity"], rule["team"], rule["hold"], *key, state, at) for state, at in found]
            if start is not None:
                kept[number] = start
        return out, kept

    def close(self) -> None:
        pass
