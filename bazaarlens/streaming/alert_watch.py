"""Alert states over a stream of samples: inactive, pending, firing, resolved.

Samples are grouped by their labels; the engine keeps each label set's state and brings it forward by timers in
event time (``alert_states``). Replays and restarts are the engine's: a batch that is repeated starts from the
state it started from before.
"""

from __future__ import annotations

from dataclasses import asdict

from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import alerts, metrics
from ..sinks.files import write_batch
from . import alert_states
from .jobs import TRIGGER, start

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_events(runs: DataFrame, keys: list[str], after: int, until: int) -> DataFrame:
    """State changes of runs (start_at, end_at, fires_at) at instants in (after, until].

    A run that reaches ``until`` has not ended yet.
    """

    def change(state: str, at: str, when) -> F.Column:
        return F.when(when, F.struct(F.lit(state).alias("state"), F.expr(at).alias("at")))

    fired = F.col("fires_at").isNotNull()
    ended = F.col("end_at") < until
    changes = F.array(
        # Without a hold time an alert fires at once and is never pending.
        change("pending", "start_at", ~fired | (F.col("fires_at") > F.col("start_at"))),
        change("firing", "fires_at", fired),
        change("resolved", "end_at + 1", fired & ended),
        change("inactive", "end_at + 1", ~fired & ended),
    )
    rows = runs.select(*keys, F.explode(F.array_compact(changes)).alias("c"))
    return rows.select(*keys, "c.state", "c.at").filter((F.col("at") > after) & (F.col("at") <= until))


def watch(
    stream: DataFrame,
    rules: list[alerts.Rule],
    out: str,
    checkpoint: str,
    labels: list[str] = alerts.LABELS,
    step: int = metrics.EVALUATION_STEP,
    lookback: int = metrics.LOOKBACK,
    once: bool = False,
    lateness: int = 0,
    every: str = TRIGGER,
) -> StreamingQuery:
    """Write the state changes of every alert below ``out``: alert columns, labels, state, at.

    ``stream`` has metric, the labels, ts_us and value. Instants are evaluated once the watermark, ``lateness``
    seconds behind the newest sample, has passed them: samples that come out of order by no more than that
    count as if they had come in order, later ones are dropped.
    """
    register_pickle_by_value(alert_states)
    schema = event_schema(labels)
    # A millisecond more: a sample of the newest sample's time is not late.
    samples = stream.select(
        "metric", *labels, "ts_us", "value", F.col("value").isNotNull().alias("present"), F.timestamp_micros("ts_us").alias("event_time")
    ).withWatermark("event_time", f"{lateness * 1000 + 1} milliseconds")
    processor = alert_states.AlertStates([asdict(r) for r in rules], labels, step, lookback, schema.names)
    changed = samples.groupBy(*labels).transformWithStateInPandas(processor, schema, "update", "eventTime")
    session = stream.sparkSession
    before = session.conf.get(_PROVIDER, None)
    session.conf.set(_PROVIDER, _ROCKSDB)  # keyed state with timers needs it; a query keeps what it starts with
    try:
        return start(changed, lambda batch, batch_id: write_batch(batch, out, batch_id), checkpoint, once, every)
    finally:
        if before is None:
            session.conf.unset(_PROVIDER)
        else:
            session.conf.set(_PROVIDER, before)


def event_schema(labels: list[str] = alerts.LABELS) -> T.StructType:
    text = [T.StructField(name, T.StringType()) for name in ["alertname", "severity", "team"]]
    hold = [T.StructField("hold", T.IntegerType())]
    named = [T.StructField(name, T.StringType()) for name in labels]
    return T.StructType([*text, *hold, *named, T.StructField("state", T.StringType()), T.StructField("at", T.LongType())])
