"""Counter rates of a stream, as ``metrics.rate_on_grid`` gives them for a table.

The engine's event-time watermark closes an instant once samples of its time may no longer come. An open
instant's state is the samples of its window, whose number the scrape interval bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.metrics import EVALUATION_STEP, SECOND, SERIES, extrapolated_increase
from ..sinks.files import write_batch
from . import jobs

WINDOW = 300
LATENESS = 900


def rates(
    samples: DataFrame,
    series: list[str] = SERIES,
    window: int = WINDOW,
    step: int = EVALUATION_STEP,
    lateness: int = LATENESS,
) -> DataFrame:
    """Rows (series, at, value), each when its instant is closed.

    Samples may come up to ``lateness`` seconds out of order; later ones miss the instants already closed.
    A sample that comes twice counts once, and of two at one time the larger counts.
    """
    window_us, step_us = window * SECOND, step * SECOND
    first, last = F.expr(f"(ts_us + {step_us - 1}) div {step_us}"), F.expr(f"(ts_us + {window_us}) div {step_us}")
    spread = samples.filter(F.col("value").isNotNull() & (first <= last)).withColumn("at", F.explode(F.sequence(first, last)))
    # A sample reaches instants up to a window later, which the watermark must not take for the present.
    timed = spread.withColumn("time", F.timestamp_micros(F.col("at") * step_us)).withWatermark("time", f"{window + lateness} seconds")
    held = timed.groupBy(*series, "time").agg(F.array_sort(F.collect_set(F.struct("ts_us", "value"))).alias("held"))
    newest = F.filter("held", lambda row, i: ~F.coalesce(F.get("held", i + 1)["ts_us"] == row["ts_us"], F.lit(False)))
    rows = held.withColumn("held", newest).filter(F.size("held") > 1)
    start = F.struct(F.get("held", F.lit(0))["value"].alias("value"), F.lit(0.0).alias("lost"))
    lost = F.aggregate(
        "held",
        start,
        lambda before, row: F.struct(
            row["value"].alias("value"),
            (before["lost"] + F.when(row["value"] < before["value"], before["value"]).otherwise(F.lit(0.0))).alias("lost"),
        ),
    )["lost"]
    oldest, latest, end = F.get("held", F.lit(0)), F.element_at("held", -1), F.unix_micros("time")
    total = extrapolated_increase(
        oldest["ts_us"],
        latest["ts_us"],
        latest["value"] - oldest["value"] + lost,
        oldest["value"],
        F.size("held"),
        end - window_us,
        end,
    )
    return rows.select(*series, F.expr(f"unix_micros(time) div {step_us}").alias("at"), (total / float(window)).alias("value"))


def follow(stream: DataFrame, out: str, checkpoint: str, once: bool = False, every: str = jobs.TRIGGER, **how) -> StreamingQuery:
    """Write the rates of a stream of samples below ``out``, each row once."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, out, batch_id)

    return jobs.start(rates(stream, **how), handle, checkpoint, once, every)


def late_rows(query: StreamingQuery) -> int:
    """Contributions to closed instants that came too late, of the batches whose progress the session still has."""
    return sum(state["numRowsDroppedByWatermark"] for p in query.recentProgress for state in p["stateOperators"])
