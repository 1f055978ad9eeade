"""Time series: newest sample on an evaluation grid, counter rates, ratios, latest status.

A series is split by time before anything is ordered: rows meet in (series, time slice) groups,
and each group also gets the few rows before it that its first results look back to. So one busy
series is spread over many tasks. Times are microseconds since the epoch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SECOND = 1_000_000
SERIES = ["metric", "job", "cluster", "instance"]
# Rule evaluation interval and look-back of an instant, in seconds.
EVALUATION_STEP = 30
LOOKBACK = 300
# Instants per time slice: an hour of evaluations.
SLICE_STEPS = 120


OTHER_LABELS = "other_labels"


def from_labels(samples: DataFrame, labels: list[str]) -> DataFrame:
    """Scraped samples (``schemas.METRIC_SAMPLE``) as evaluator input: metric, labels, ts_us, value.

    Labels that ``labels`` does not name stay in one text column, ``other_labels``, so that series which
    differ only there stay apart if it is among the series columns. A missing label is null.
    """
    own = [name for name in labels if name in samples.columns]
    mapped = [F.element_at("labels", name).alias(name) for name in labels if name not in own]
    rest = F.map_filter("labels", lambda key, value: ~key.isin(*labels) & value.isNotNull())
    pairs = F.transform(F.array_sort(F.map_entries(rest)), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    others = F.array_join(F.coalesce(pairs, F.array().cast("array<string>")), ",").alias(OTHER_LABELS)
    return samples.select("metric", *own, *mapped, others, F.unix_micros("ts").alias("ts_us"), "value")


def sample_spans(
    samples: DataFrame,
    series: list[str] = SERIES,
    step: int = EVALUATION_STEP,
    lookback: int = LOOKBACK,
    slice_steps: int = SLICE_STEPS,
) -> DataFrame:
    """The grid instants at which each sample is its series' value: from_at to to_at.

    At instant t a series has the value of its newest sample in [t - lookback, t]. ``samples`` has
    the series columns, ts_us and value; the result has the series columns, value, from_at and
    to_at (instants as multiples of the step). Spans of a series do not overlap and end at slice
    borders. Of two samples at one time the larger counts.
    """
    step_us, lookback_us = step * SECOND, lookback * SECOND
    cell = F.expr(f"(ts_us + {step_us - 1}) div {step_us}")
    reach = F.expr(f"(ts_us + {lookback_us}) div {step_us}")
    # Within one step only the newest sample can be the newest at an instant. Reducing to it
    # first also folds copies of a sample before they are shuffled.
    newest = (
        samples.filter(F.col("value").isNotNull())
        .groupBy(*series, cell.alias("cell"))
        .agg(F.max(F.struct("ts_us", "value")).alias("newest"))
        .select(*series, "cell", F.col("newest.ts_us").alias("ts_us"), F.col("newest.value").alias("value"))
        .withColumn("reach", reach)
        .filter(F.col("cell") <= F.col("reach"))
    )
    slices = F.expr(f"sequence(cell div {slice_steps}, reach div {slice_steps})")
    spread = newest.withColumn("slice", F.explode(slices))
    group = Window.partitionBy(*series, "slice").orderBy("cell")
    first, last = F.col("slice") * slice_steps, F.col("slice") * slice_steps + (slice_steps - 1)
    spans = spread.withColumn("following", F.lead("cell").over(group)).select(
        *series,
        "value",
        F.greatest("cell", first).alias("from_at"),
        F.least("reach", F.col("following") - 1, last).alias("to_at"),
    )
    return spans.filter(F.col("from_at") <= F.col("to_at"))


def at_instants(spans: DataFrame) -> DataFrame:
    """One row per instant of each span, as ``at``."""
    return spans.withColumn("at", F.explode(F.sequence("from_at", "to_at"))).drop("from_at", "to_at")


def sample_on_grid(
    samples: DataFrame,
    series: list[str] = SERIES,
    step: int = EVALUATION_STEP,
    lookback: int = LOOKBACK,
    slice_steps: int = SLICE_STEPS,
) -> DataFrame:
    """The value of each series at every grid instant: rows (series, value, at)."""
    return at_instants(sample_spans(samples, series, step, lookback, slice_steps))


def _with_drop(samples: DataFrame, series: list[str], window_us: int, slice_us: int) -> DataFrame:
    """Samples in (series, slice) groups, each with the ``window_us`` before it, and ``drop``: the
    value a counter lost in a reset just before the sample."""
    unique = samples.filter(F.col("value").isNotNull()).groupBy(*series, "ts_us").agg(F.max("value").alias("value"))
    slices = F.expr(f"sequence(ts_us div {slice_us}, (ts_us + {window_us}) div {slice_us})")
    spread = unique.withColumn("slice", F.explode(slices))
    before = F.lag("value").over(Window.partitionBy(*series, "slice").orderBy("ts_us"))
    return spread.withColumn("drop", F.when(F.col("value") < before, before).otherwise(F.lit(0.0)))


def extrapolated_increase(
    first_us: Column, last_us: Column, increase: Column, first: Column, n: Column, from_us: Column, to_us: Column
) -> Column:
    """A counter's increase over a whole range, from its increase between the samples inside it.

    The samples cover less than the range. Each end is filled up to the range boundary, or only by
    half a sample distance if that is 1.1 distances or more; the start boundary is where the
    counter would have been zero, if that is nearer.
    """
    covered = (last_us - first_us).cast("double")
    distance = covered / (n - 1)
    limit = distance * 1.1
    head, tail = (first_us - from_us).cast("double"), (to_us - last_us).cast("double")
    to_zero = F.when((increase > 0) & (first >= 0), covered * (first / increase))
    head = F.when(to_zero < head, to_zero).otherwise(head)
    head = F.when(head >= limit, distance / 2).otherwise(head)
    tail = F.when(tail >= limit, distance / 2).otherwise(tail)
    return increase * ((covered + head + tail) / covered)


def counter_rate(
    samples: DataFrame,
    series: list[str] = SERIES,
    window: int = 300,
    slice_windows: int = 12,
    extrapolate: bool = True,
) -> DataFrame:
    """Per-second rate of a counter over [t - window, t] at each sample time t.

    A value below its predecessor is a reset. Fewer than two samples in the window give no row.
    Without ``extrapolate`` it is the plain increase between the samples divided by the window.
    """
    window_us = window * SECOND
    slice_us = window_us * slice_windows
    rows = _with_drop(samples, series, window_us, slice_us)
    span = Window.partitionBy(*series, "slice").orderBy("ts_us").rangeBetween(-window_us, Window.currentRow)
    rows = rows.select(
        *series,
        "slice",
        "ts_us",
        "value",
        F.count("value").over(span).alias("n"),
        F.first("ts_us").over(span).alias("first_us"),
        F.first("value").over(span).alias("first_value"),
        (F.sum("drop").over(span) - F.first("drop").over(span)).alias("lost"),
    )
    own = rows.filter((F.col("slice") == F.expr(f"ts_us div {slice_us}")) & (F.col("n") > 1))
    increase = F.col("value") - F.col("first_value") + F.col("lost")
    if extrapolate:
        increase = extrapolated_increase(
            F.col("first_us"),
            F.col("ts_us"),
            increase,
            F.col("first_value"),
            F.col("n"),
            F.col("ts_us") - window_us,
            F.col("ts_us"),
        )
    return own.select(*series, "ts_us", F.col("n").alias("samples"), (increase / float(window)).alias("rate"))


def rate_on_grid(
    samples: DataFrame, series: list[str] = SERIES, window: int = 300, step: int = EVALUATION_STEP
) -> DataFrame:
    """As ``counter_rate``, at grid instants: rows (series, at, value).

    Each sample contributes to the instants whose window holds it; partial sums do the rest.
    """
    window_us, step_us = window * SECOND, step * SECOND
    rows = _with_drop(samples, series, window_us, window_us * 12)
    rows = rows.filter(F.col("slice") == F.expr(f"ts_us div {window_us * 12}"))
    instants = F.expr(f"sequence((ts_us + {step_us - 1}) div {step_us}, (ts_us + {window_us}) div {step_us})")
    reached = F.expr(f"(ts_us + {step_us - 1}) div {step_us} <= (ts_us + {window_us}) div {step_us}")
    # Sample times are unique by now, so first and last values are hash aggregates of plain numbers.
    spans = (
        rows.filter(reached)
        .withColumn("at", F.explode(instants))
        .groupBy(*series, "at")
        .agg(
            F.count("*").alias("n"),
            F.min("ts_us").alias("first_us"),
            F.max("ts_us").alias("last_us"),
            F.min_by("value", "ts_us").alias("first_value"),
            F.max_by("value", "ts_us").alias("last_value"),
            (F.sum("drop") - F.min_by("drop", "ts_us")).alias("lost"),
        )
        .filter("n > 1")
    )
    end = F.col("at") * step_us
    total = extrapolated_increase(
        F.col("first_us"),
        F.col("last_us"),
        F.col("last_value") - F.col("first_value") + F.col("lost"),
        F.col("first_value"),
        F.col("n"),
        end - window_us,
        end,
    )
    return spans.select(*series, "at", (total / float(window)).alias("value"))


def divide(numerator: Column, denominator: Column) -> Column:
    """Floating-point division: x/0 is infinite, 0/0 is not a number."""
    by_zero = (
        F.when(numerator > 0, F.lit(float("inf")))
        .when(numerator < 0, F.lit(float("-inf")))
        .otherwise(F.lit(float("nan")))
    )
    return F.when(denominator == 0, by_zero).otherwise(numerator / denominator)


def ratio(
    samples: DataFrame, numerator: str, denominator: str, keys: list[str], scale: float = 1.0
) -> DataFrame:
    """numerator / denominator where both metrics have a sample under the same keys.

    One conditional aggregate instead of a self-join.
    """

    def of(metric: str) -> Column:
        return F.max(F.when(F.col("metric") == metric, F.col("value")))

    pairs = (
        samples.filter(F.col("metric").isin(numerator, denominator))
        .groupBy(*keys)
        .agg(of(numerator).alias("num"), of(denominator).alias("den"))
        .filter("num is not null and den is not null")
    )
    return pairs.select(*keys, (divide(F.col("num"), F.col("den")) * scale).alias("value"))


def ratio_spans(
    spans: DataFrame, numerator: str, denominator: str, keys: list[str], slice_steps: int = SLICE_STEPS
) -> DataFrame:
    """numerator / denominator while both have a value: rows (keys, value, from_at, to_at).

    ``spans`` are those of ``sample_spans``, with ``metric``; spans of a metric do not overlap under the same
    keys. A sweep over the starts of both metrics' spans in each time slice: the newest span of each is the
    one that may hold at a start, so no pairs are formed and no instants written out.
    """

    def of(metric: str) -> Column:
        return F.max(F.when(F.col("metric") == metric, F.struct("to_at", "value")))

    sliced = spans.filter(F.col("metric").isin(numerator, denominator))
    sliced = sliced.withColumn("slice", F.expr(f"from_at div {slice_steps}")).repartition(*keys, "slice")
    starts = sliced.groupBy(*keys, "slice", "from_at").agg(of(numerator).alias("num"), of(denominator).alias("den"))
    in_order = Window.partitionBy(*keys, "slice").orderBy("from_at")
    upto = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = starts.select(
        *keys,
        "from_at",
        F.last("num", ignorenulls=True).over(upto).alias("num"),
        F.last("den", ignorenulls=True).over(upto).alias("den"),
        (F.lead("from_at").over(in_order) - 1).alias("before_next"),
    )
    held = swept.filter("num.to_at >= from_at and den.to_at >= from_at")
    return held.select(
        *keys,
        divide(F.col("num.value"), F.col("den.value")).alias("value"),
        "from_at",
        F.least("num.to_at", "den.to_at", "before_next").alias("to_at"),
    )


def status_latest(samples: DataFrame, metric: str = "up") -> DataFrame:
    """The newest value of a metric per instance; below 1 is red."""
    newest = (
        samples.filter(F.col("metric") == metric)
        .groupBy("cluster", "instance")
        .agg(F.max(F.struct("ts_us", "value")).alias("newest"))
    )
    value = F.col("newest.value")
    return newest.select(
        "cluster",
        "instance",
        F.col("newest.ts_us").alias("ts_us"),
        value.alias("value"),
        F.when(value < 1, F.lit("red")).otherwise(F.lit("green")).alias("status"),
    )
