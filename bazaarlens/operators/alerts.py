"""Alert rules over metric samples: matching, hold time, routing, grouping, inhibition, timing.

Rules are evaluated on a regular grid. ``at`` is a grid instant (a multiple of the step); a run is
a stretch of instants without a gap at which a rule held for one series.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.jsontext import first_case
from ..functions.text import nearest
from . import metrics

LABELS = ["job", "cluster", "instance", "area"]
ALERT = ["alertname", "severity", "team", "hold"]


@dataclass(frozen=True)
class Rule:
    """``metric op threshold``; with ``per`` the ratio metric/per, with ``window`` the rate."""

    alertname: str
    metric: str
    op: str
    threshold: float
    hold: int
    severity: str
    team: str = "kafka"
    per: str | None = None
    window: int | None = None
    labels: dict[str, str] = field(default_factory=dict)
    patterns: dict[str, str] = field(default_factory=dict)
    summary: str = ""
    description: str = ""


# The shipped alert rules.
ALERT_RULES = [
    Rule(
        "KafkaBrokerDown",
        "up",
        "==",
        0,
        60,
        "critical",
        patterns={"job": "kafka-cluster-.*"},
        summary="Kafka broker is down (instance {{ $labels.instance }})",
        description="Kafka broker {{ $labels.instance }} has been down for more than 1 minute.",
    ),
    Rule(
        "KafkaBrokerUnderReplicatedPartitions",
        "kafka_server_ReplicaManager_UnderReplicatedPartitions",
        ">",
        0,
        300,
        "warning",
        summary="Kafka broker has under-replicated partitions (instance {{ $labels.instance }})",
        description="Broker {{ $labels.instance }} has {{ $value }} under-replicated partitions"
        " for more than 5 minutes.",
    ),
    Rule(
        "KafkaBrokerOfflinePartitionsCount",
        "kafka_server_ReplicaManager_OfflinePartitionsCount",
        ">",
        0,
        60,
        "critical",
        summary="Kafka broker has offline partitions (instance {{ $labels.instance }})",
        description="Broker {{ $labels.instance }} has {{ $value }} offline partitions for more than 1 minute.",
    ),
    Rule(
        "KafkaBrokerActiveControllerCount",
        "kafka_controller_KafkaController_ActiveControllerCount",
        "==",
        0,
        120,
        "critical",
        summary="Kafka cluster has no active controller",
        description="No active controller in Kafka cluster for more than 2 minutes.",
    ),
    Rule(
        "KafkaBrokerRequestHandlerIdle",
        "kafka_request_handler_AvgIdlePercent",
        "<",
        10,
        600,
        "warning",
        summary="Kafka broker request handlers are overloaded (instance {{ $labels.instance }})",
        description="Broker {{ $labels.instance }} average idle percent is {{ $value }}%"
        " for more than 10 minutes.",
    ),
    Rule(
        "KafkajvmMemoryHigh",
        "jvm_memory_heap_bytes",
        ">",
        0.9,
        300,
        "warning",
        per="jvm_memory_heap_bytes_max",
        labels={"area": "heap"},
        summary="Kafka JVM heap memory usage high (instance {{ $labels.instance }})",
        description="Broker {{ $labels.instance }} heap memory usage is {{ $value | humanizePercentage }}"
        " for more than 5 minutes.",
    ),
    Rule(
        "KafkaBrokerProducerRequestRateLow",
        "kafka_server_BrokerTopicMetrics_BytesInPerSec_total",
        "<",
        100,
        900,
        "info",
        window=300,
        summary="Low producer request rate (instance {{ $labels.instance }})",
        description="Broker {{ $labels.instance }} producer request rate is low: {{ $value }} bytes/sec"
        " for more than 15 minutes.",
    ),
]

# Routes in order (severity, receiver, seconds to wait before a group's first
# notice), the default route, and the group and repeat intervals in seconds.
ROUTES = [("critical", "critical", 10), ("warning", "warning", 30), ("info", "info", 30)]
DEFAULT_RECEIVER = "default"
GROUP_WAIT = 30
GROUP_INTERVAL = 300
REPEAT_INTERVAL = 43200
GROUP_BY = ["alertname", "cluster"]
INHIBITING, INHIBITED = "critical", "warning"

COMPARE = {
    "==": Column.__eq__,
    ">": Column.__gt__,
    "<": Column.__lt__,
    ">=": Column.__ge__,
    "<=": Column.__le__,
    "!=": Column.__ne__,
}


def breaches(rule: Rule, value: Column) -> Column:
    """The threshold test; a value that is not a number only satisfies ``!=``."""
    test = COMPARE[rule.op](value, F.lit(float(rule.threshold)))
    return test if rule.op == "!=" else test & ~F.isnan(value)


def selects(rule: Rule) -> Column:
    """Label matchers: equality, and patterns that must match the whole label."""
    test = F.lit(True)
    for label, text in rule.labels.items():
        test = test & (F.coalesce(F.col(label), F.lit("")) == text)
    for label, pattern in rule.patterns.items():
        test = test & F.coalesce(F.col(label), F.lit("")).rlike(rf"\A(?:{pattern})\z")
    return test


def _tag(rule: Rule) -> Column:
    return F.struct(
        F.lit(rule.alertname).alias("alertname"),
        F.lit(rule.severity).alias("severity"),
        F.lit(rule.team).alias("team"),
        F.lit(rule.hold).alias("hold"),
    )


def _matched(evaluated: DataFrame, rules: list[tuple[Rule, Column]], labels: list[str]) -> DataFrame:
    """One row per rule that holds, all rules in one pass over the evaluated series."""
    tags = [F.when(test & breaches(rule, F.col("value")), _tag(rule)) for rule, test in rules]
    return evaluated.withColumn("tag", F.explode(F.array_compact(F.array(*tags)))).select(
        *[F.col(f"tag.{name}").alias(name) for name in ALERT], *labels, "from_at", "to_at", "value"
    )


def evaluate(
    samples: DataFrame,
    rules: list[Rule],
    labels: list[str] = LABELS,
    step: int = metrics.EVALUATION_STEP,
    lookback: int = metrics.LOOKBACK,
) -> DataFrame:
    """Spans of instants at which a rule's condition is true: alert columns, labels, from_at,
    to_at, value.

    ``samples`` has metric, the label columns, ts_us and value. A threshold on a sample, or on a ratio of two,
    holds as long as the samples count, so its instants are never written out one by one.
    """
    series = ["metric", *labels]
    single = [F.col("at").alias("from_at"), F.col("at").alias("to_at")]
    plain = [r for r in rules if not r.per and not r.window]
    parts = []
    if plain:
        wanted = samples.filter(F.col("metric").isin(*sorted({r.metric for r in plain})))
        spans = metrics.sample_spans(wanted, series, step, lookback)
        parts.append(_matched(spans, [(r, (F.col("metric") == r.metric) & selects(r)) for r in plain], labels))
    for rule in (r for r in rules if r.per):
        both = samples.filter(F.col("metric").isin(rule.metric, rule.per) & selects(rule))
        ratios = metrics.ratio_spans(metrics.sample_spans(both, series, step, lookback), rule.metric, rule.per, labels)
        parts.append(_matched(ratios, [(rule, F.lit(True))], labels))
    for rule in (r for r in rules if r.window):
        chosen = samples.filter((F.col("metric") == rule.metric) & selects(rule))
        rates = metrics.rate_on_grid(chosen, series, rule.window, step)
        parts.append(_matched(rates.select("*", *single), [(rule, F.lit(True))], labels))
    if not parts:
        nothing = samples.select(*labels, F.col("ts_us").alias("at"), "value").select("*", *single)
        return _matched(nothing, [(ALERT_RULES[0], F.lit(False))], labels)
    matches = parts[0]
    for part in parts[1:]:
        matches = matches.unionByName(part)
    return matches


def runs(
    spans: DataFrame, keys: list[str], slice_steps: int = 24 * metrics.SLICE_STEPS, starts: str | None = None
) -> DataFrame:
    """Stretches of instants without a gap: rows (keys, start_at, end_at, value, continues).

    ``spans`` has the keys, from_at, to_at and value; spans of a key do not overlap and none
    crosses a multiple of ``slice_steps``. The value of a run is that of its last span. A true
    ``starts`` column begins a new run even without a gap, marked ``continues``.

    Runs are found per time slice first. Only runs that touch a slice border can go on in the
    next slice, so at most two rows per slice meet in the second step, however busy the key is.
    """
    forced = F.coalesce(F.col(starts), F.lit(False)) if starts else F.lit(False)
    rows = spans.withColumn("slice", F.expr(f"from_at div {slice_steps}")).withColumn("forced", forced)
    in_order = Window.partitionBy(*keys, "slice").orderBy("from_at")
    adjacent = F.coalesce(F.lag("to_at").over(in_order) == F.col("from_at") - 1, F.lit(False))
    rows = rows.withColumn("adjacent", adjacent).withColumn("new", (F.col("forced") | ~F.col("adjacent")).cast("int"))
    pieces = (
        rows.withColumn("piece", F.sum("new").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "slice", "piece")
        .agg(
            F.min("from_at").alias("start_at"),
            F.max("to_at").alias("end_at"),
            F.max_by("value", "from_at").alias("value"),
            F.min_by("forced", "from_at").alias("forced"),
            F.min_by("adjacent", "from_at").alias("continues"),
        )
    )
    first = F.col("slice") * slice_steps
    border = (F.col("start_at") == first) | (F.col("end_at") == first + slice_steps - 1)
    # Inner pieces are whole runs: each is a group of its own. All border pieces of a key meet.
    pieces = pieces.withColumn("meeting", F.when(border, F.lit(-1)).otherwise(F.col("start_at")))
    by_start = Window.partitionBy(*keys, "meeting").orderBy("start_at")
    follows = F.coalesce(F.lag("end_at").over(by_start) == F.col("start_at") - 1, F.lit(False))
    pieces = (
        pieces.withColumn("follows", follows)
        .withColumn("new", (F.col("forced") | ~F.col("follows")).cast("int"))
        .withColumn("run", F.sum("new").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    )
    return (
        pieces.groupBy(*keys, "meeting", "run")
        .agg(
            F.min("start_at").alias("start_at"),
            F.max("end_at").alias("end_at"),
            F.max_by("value", "start_at").alias("value"),
            F.min_by(F.col("forced") & (F.col("continues") | F.col("follows")), "start_at").alias("continues"),
        )
        .drop("meeting", "run")
    )


def with_state(found: DataFrame, step: int = metrics.EVALUATION_STEP) -> DataFrame:
    """Adds ``fires_at``, the instant the hold time of a run is over, and ``state``."""
    fires = F.col("start_at") + F.ceil(F.col("hold") / step)
    firing = F.col("end_at") >= fires
    return found.withColumn("fires_at", F.when(firing, fires)).withColumn(
        "state", F.when(firing, F.lit("firing")).otherwise(F.lit("pending"))
    )


def alert_runs(
    matches: DataFrame, labels: list[str] = LABELS, step: int = metrics.EVALUATION_STEP
) -> DataFrame:
    """The runs of each alert in the spans of ``evaluate``, with their hold state."""
    return with_state(runs(matches, [*ALERT, *labels]).drop("continues"), step)


def firing_instants(alerts: DataFrame) -> DataFrame:
    return alerts.filter("state = 'firing'").withColumn("at", F.explode(F.sequence("fires_at", "end_at")))


def inhibit(firing: DataFrame) -> DataFrame:
    """Firing instants without the warnings that a critical alert of the same group silences."""
    where = [*GROUP_BY, "at"]
    sources = _renamed(firing.filter(F.col("severity") == INHIBITING).select(*where).distinct(), where)
    silenced = _same(firing, sources, where) & (firing["severity"] == INHIBITED)
    return firing.join(sources, silenced, "left_anti")


def route(alerts: DataFrame) -> DataFrame:
    """Adds ``receiver`` and ``group_wait`` of the first route that matches the severity."""
    receiver = first_case([(F.col("severity") == s, F.lit(r)) for s, r, _ in ROUTES])
    wait = first_case([(F.col("severity") == s, F.lit(w)) for s, _, w in ROUTES])
    return alerts.withColumn("receiver", F.coalesce(receiver, F.lit(DEFAULT_RECEIVER))).withColumn(
        "group_wait", F.coalesce(wait, F.lit(GROUP_WAIT))
    )


def group(alerts: DataFrame) -> DataFrame:
    """Size and time span of each notification group; members stay rows of ``alerts``."""
    return alerts.groupBy(*GROUP_BY).agg(
        F.count("*").alias("alert_count"),
        F.countDistinct("instance").alias("instance_count"),
        F.min("fires_at").alias("first_at"),
        F.max("end_at").alias("last_at"),
    )


# Firing stretches are cut at these borders, so that a group's stretches meet slice by slice.
SLICE = 24 * metrics.SLICE_STEPS


def _sliced(alerts: DataFrame) -> DataFrame:
    """Firing alerts as spans that end at slice borders: from_at, to_at and the slice."""
    slices = F.sequence(F.expr(f"fires_at div {SLICE}"), F.expr(f"end_at div {SLICE}"))
    rows = alerts.filter("state = 'firing'").withColumn("slice", F.explode(slices))
    first = F.col("slice") * SLICE
    return rows.withColumns({"from_at": F.greatest("fires_at", first), "to_at": F.least("end_at", first + SLICE - 1)})


def _merged(spans: DataFrame, keys: list[str]) -> DataFrame:
    """The union of the spans of each key and slice: spans that neither overlap nor touch."""
    order = Window.partitionBy(*keys, "slice").orderBy("from_at", "to_at")
    reached = F.max("to_at").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begun = F.coalesce(F.col("from_at") > reached + 1, F.lit(True)).cast("int")
    numbered = spans.withColumn("begun", begun).withColumn(
        "piece", F.sum("begun").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    united = numbered.groupBy(*keys, "slice", "piece").agg(F.min("from_at").alias("from_at"), F.max("to_at").alias("to_at"))
    return united.drop("piece")


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equal keys; a missing label equals a missing label."""
    test = F.lit(True)
    for key in keys:
        test = test & left[key].eqNullSafe(right[f"_{key}"])
    return test


def _renamed(rows: DataFrame, names: list[str]) -> DataFrame:
    return rows.select(*[F.col(n).alias(f"_{n}") for n in names])


def inhibit_runs(alerts: DataFrame, labels: list[str] = LABELS) -> DataFrame:
    """The firing stretches of alerts that no critical alert of the same group silences.

    Rows as those of ``alert_runs``, beginning where the alert is heard: fires_at is start_at. Stretches
    are compared slice by slice; no instant is written out.
    """
    spans = _sliced(alerts).select(*ALERT, *labels, "slice", "from_at", "to_at", "value")
    where = [*GROUP_BY, "slice"]
    silent = _merged(spans.filter(F.col("severity") == INHIBITING).select(*where, "from_at", "to_at"), GROUP_BY)
    order = Window.partitionBy(*where).orderBy("from_at")
    first = F.col("slice") * SLICE
    heard_from = F.coalesce(F.lag("to_at").over(order) + 1, first)
    last = F.lead("from_at").over(order).isNull()
    gaps = silent.withColumn("before", F.struct(heard_from.alias("a"), (F.col("from_at") - 1).alias("b")))
    after = F.when(last, F.struct((F.col("to_at") + 1).alias("a"), (first + SLICE - 1).alias("b")))
    gaps = gaps.withColumn("after", after)
    gaps = gaps.withColumn("gap", F.explode(F.array_compact(F.array("before", "after"))))
    gaps = gaps.select(*where, F.col("gap.a").alias("a"), F.col("gap.b").alias("b"))
    quiet = _renamed(gaps, [*where, "a", "b"])
    warned = spans.filter(F.col("severity") == INHIBITED)
    cut = warned.join(quiet, _same(warned, quiet, where), "left")
    cut = cut.withColumns(
        {"from_at": F.greatest("from_at", F.coalesce("_a", "from_at")), "to_at": F.least("to_at", F.coalesce("_b", "to_at"))}
    ).filter("from_at <= to_at")
    others = spans.filter(F.col("severity") != INHIBITED)
    names = [*ALERT, *labels, "from_at", "to_at", "value"]
    heard = runs(others.select(*names).unionByName(cut.select(*names)), [*ALERT, *labels])
    return heard.drop("continues").withColumns({"fires_at": F.col("start_at"), "state": F.lit("firing")})


def schedule(
    alerts: DataFrame, step: int = metrics.EVALUATION_STEP, repeat: int = REPEAT_INTERVAL, interval: int = GROUP_INTERVAL
) -> DataFrame:
    """Notification times in seconds: rows (receiver, alertname, cluster, notify_s).

    A group is first notified ``group_wait`` after it begins to fire, if it still fires then. From that
    notice on it is looked at every group interval: there is a notice if an alert joined since the last
    look, or if the repeat interval has passed since the last notice.
    """
    keys = ["receiver", "group_wait", *GROUP_BY]
    routed = route(alerts)
    united = _merged(_sliced(routed).select(*keys, "slice", "from_at", "to_at"), keys)
    groups = runs(united.select(*keys, "from_at", "to_at", F.lit(0).alias("value")), keys)
    begin = F.col("start_at") * step + F.col("group_wait")
    looks = F.floor(((F.col("end_at") + 1) * step - 1 - begin) / interval)
    groups = groups.select(*keys, "start_at", "end_at", begin.alias("first_s"), looks.alias("looks"))
    groups = groups.filter("looks >= 0")
    # Alerts meet their group's stretch in the slice in which they begin.
    slices = F.sequence(F.expr(f"start_at div {SLICE}"), F.expr(f"end_at div {SLICE}"))
    there = _renamed(groups.withColumn("slice", F.explode(slices)), [*keys, "slice", "start_at", "end_at", "first_s", "looks"])
    joining = routed.filter("state = 'firing'").select(*keys, "fires_at", F.expr(f"fires_at div {SLICE}").alias("slice"))
    joined = joining.join(there, _same(joining, there, [*keys, "slice"])).filter("fires_at between _start_at and _end_at")
    look = F.greatest(F.ceil((F.col("fires_at") * step - F.col("_first_s")) / interval), F.lit(0))
    marks = joined.select(*keys, "_start_at", "_first_s", "_looks", look.alias("mark")).filter("mark <= _looks").distinct()
    in_order = Window.partitionBy(*keys, "_start_at").orderBy("mark")
    until = F.coalesce(F.lead("mark").over(in_order) - 1, F.col("_looks"))
    marks = marks.withColumn("until", until)
    notices = F.sequence(F.col("mark"), F.col("until"), F.lit(-(-repeat // interval)).cast("bigint"))
    return marks.withColumn("notice", F.explode(notices)).select(
        "receiver", *GROUP_BY, (F.col("_first_s") + F.col("notice") * interval).alias("notify_s")
    )


# --- annotations ---


def _decimal(value: Column) -> tuple[Column, Column]:
    """The digits of a number without leading and trailing zeros, and where the point stands before them."""
    text = F.abs(value).cast("string")
    whole, part = (F.regexp_extract(text, r"^([0-9]+)\.([0-9]+)", i) for i in (1, 2))
    power = F.coalesce(F.nullif(F.regexp_extract(text, r"E(-?[0-9]+)$", 1), F.lit("")).cast("int"), F.lit(0))
    raw = F.concat(whole, part)
    digits = F.ltrim(raw, F.lit("0"))
    point = F.length(whole) + power - (F.length(raw) - F.length(digits))
    return F.rtrim(digits, F.lit("0")), point


def _laid_out(value: Column, digits: Column, point: Column, limit: int) -> Column:
    """Digits with a point, or with an exponent below -4 or from ``limit`` on, as the template language prints."""
    size, power = F.length(digits), point - 1
    rest = F.substring(digits, F.lit(2), F.greatest(size - 1, F.lit(0)))
    mantissa = F.concat(F.substring(digits, 1, 1), F.when(size > 1, F.concat(F.lit("."), rest)).otherwise(F.lit("")))
    exponent = F.concat(
        F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.abs(power) < 10, F.lit("0")).otherwise(F.lit("")),
        F.abs(power).cast("string"),
    )
    plain = first_case(
        [
            (point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits)),
            (point >= size, F.concat(digits, F.repeat(F.lit("0"), point - size))),
            (F.lit(True), F.concat(F.substring(digits, F.lit(1), point), F.lit("."), F.substring(digits, point + 1, size))),
        ]
    )
    text = F.when((power < -4) | (power >= limit), F.concat(mantissa, exponent)).otherwise(plain)
    return F.concat(F.when(value < 0, F.lit("-")).otherwise(F.lit("")), text)


def _special(value: Column, other: Column) -> Column:
    return first_case(
        [
            (F.isnan(value), F.lit("NaN")),
            (value == F.lit(float("inf")), F.lit("+Inf")),
            (value == F.lit(float("-inf")), F.lit("-Inf")),
            (value == 0, F.lit("0")),
            (F.lit(True), other),
        ]
    )


def plain_number(value: Column) -> Column:
    """The number's shortest digits: 5, 0.25, 0.016666666666666666, 1e-05, 1.2e+07."""
    return _special(value, _laid_out(value, *_decimal(value), 6))


def percentage(value: Column) -> Column:
    """A share as a percentage with four significant digits."""
    percent = value * 100
    size = F.abs(percent)
    steps = [(1000, 1.0), (100, 10.0), (10, 100.0), (1, 1e3), (0.1, 1e4), (0.01, 1e5), (0.001, 1e6)]
    power = first_case([(size >= low, F.lit(by)) for low, by in steps])
    known = (size >= 0.001) & (size < 9999.5)
    near = F.when(known, percent)  # the exact rounding is only computed where it is good
    text = (nearest(near, power).cast("decimal(20,0)") * (F.lit(1.0) / power).cast("decimal(7,6)")).cast("string")
    digits, point = _decimal(percent)
    kept = F.substring(digits, 1, 4).cast("int") + F.when(F.substring(digits, 5, 1) >= "5", 1).otherwise(0)
    carried = kept == 10000
    shown = F.rtrim(F.when(carried, F.lit("1")).otherwise(kept.cast("string")), F.lit("0"))
    rounded = _laid_out(percent, shown, point + carried.cast("int"), 4)
    return F.concat(
        F.when(known, F.regexp_replace(text, r"\.?0+$", "")).otherwise(_special(percent, rounded)), F.lit("%")
    )


PLAIN, SHARE = "_plain", "_share"


def fill(template: str) -> Column:
    """A text with {{ $labels.x }}, {{ $value }} and {{ $value | humanizePercentage }} filled in.

    The two forms of the value are columns, see ``annotate``.
    """
    parts = []
    for piece in re.split(r"(\{\{.*?\}\})", template):
        inner = piece[2:-2].strip() if piece.startswith("{{") else None
        if inner is None:
            parts.append(F.lit(piece))
        elif inner.startswith("$labels."):
            parts.append(F.coalesce(F.col(inner.removeprefix("$labels.")), F.lit("")))
        elif inner == "$value":
            parts.append(F.col(PLAIN))
        elif inner.replace(" ", "") == "$value|humanizePercentage":
            parts.append(F.col(SHARE))
        else:
            raise ValueError(f"unknown placeholder {piece}")
    return F.concat(*parts)


def annotate(alerts: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``summary`` and ``description`` from the templates of each alert's rule."""
    mine = [((F.col("alertname") == r.alertname) & (F.col("severity") == r.severity), r) for r in rules]
    return (
        alerts.withColumns({PLAIN: plain_number(F.col("value")), SHARE: percentage(F.col("value"))})
        .withColumns(
            {
                "summary": first_case([(test, fill(r.summary)) for test, r in mine]),
                "description": first_case([(test, fill(r.description)) for test, r in mine]),
            }
        )
        .drop(PLAIN, SHARE)
    )
