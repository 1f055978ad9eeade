import math
import random

import pytest
from pyspark.sql import functions as F

from bazaarlens.functions import metric_names
from bazaarlens.operators import metrics

SECOND = metrics.SECOND
SERIES = ["metric", "instance"]
SCHEMA = "metric string, instance string, ts_us long, value double"
START = 1_704_067_200 * SECOND


def make(rng, n=120, span=3000, counters=False):
    rows, level = [], {}
    for _ in range(n):
        key = ("m", rng.choice(["a", "b"]))
        rows.append([*key, START + rng.randrange(span * 2) * SECOND // 2, float(rng.randrange(50))])
    if counters:
        rows.sort(key=lambda r: r[2])
        for row in rows:
            level[row[1]] = 0.0 if rng.random() < 0.08 else level.get(row[1], 0.0) + row[3]
            row[3] = level[row[1]]
    return [tuple(r) for r in rows]


def folded(rows):
    """Per series, the larger value of each time, in order."""
    series = {}
    for metric, instance, ts, value in rows:
        at = series.setdefault((metric, instance), {})
        at[ts] = max(value, at.get(ts, value))
    return {key: sorted(at.items()) for key, at in series.items()}


def brute_grid(rows, step, lookback):
    out = set()
    for key, points in folded(rows).items():
        low, high = points[0][0] // (step * SECOND), (points[-1][0] + lookback * SECOND) // (step * SECOND)
        for at in range(low, high + 1):
            t = at * step * SECOND
            seen = [p for p in points if t - lookback * SECOND <= p[0] <= t]
            if seen:
                out.add((*key, at, seen[-1][1]))
    return out


@pytest.mark.parametrize("step,lookback,slice_steps", [(30, 300, 7), (30, 300, 120), (60, 45, 3), (15, 600, 5)])
def test_newest_sample_on_grid(spark, step, lookback, slice_steps):
    rows = make(random.Random(step))
    rows += rows[:40]  # copies of samples change nothing
    found = metrics.sample_on_grid(spark.createDataFrame(rows, SCHEMA), SERIES, step, lookback, slice_steps)
    got = [tuple(r) for r in found.select("metric", "instance", "at", "value").collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute_grid(rows, step, lookback)


def brute_rate(points, end, window):
    """The published extrapolation of a counter's increase, for samples in [end - window, end]."""
    start = end - window * SECOND
    inside = [p for p in points if start <= p[0] <= end]
    if len(inside) < 2:
        return None
    increase = inside[-1][1] - inside[0][1]
    for before, after in zip(inside, inside[1:]):
        increase += before[1] if after[1] < before[1] else 0
    covered = inside[-1][0] - inside[0][0]
    gap = covered / (len(inside) - 1)
    head, tail = inside[0][0] - start, end - inside[-1][0]
    if increase > 0 and inside[0][1] >= 0:
        head = min(head, covered * (inside[0][1] / increase))
    head = head if head < gap * 1.1 else gap / 2
    tail = tail if tail < gap * 1.1 else gap / 2
    return increase * (covered + head + tail) / covered / window


@pytest.mark.parametrize("slice_windows", [1, 3, 12])
def test_rate_at_samples(spark, slice_windows):
    rows = make(random.Random(3), counters=True)
    frame = spark.createDataFrame(rows + rows[:30], SCHEMA)
    found = metrics.counter_rate(frame, SERIES, 300, slice_windows).collect()
    got = {(r["metric"], r["instance"], r["ts_us"]): r["rate"] for r in found}
    expected = {
        (*key, ts): brute_rate(points, ts, 300) for key, points in folded(rows).items() for ts, _ in points
    }
    expected = {k: v for k, v in expected.items() if v is not None}
    assert got.keys() == expected.keys()
    assert all(math.isclose(got[k], expected[k], rel_tol=1e-9, abs_tol=1e-12) for k in got)


def test_rate_on_grid(spark):
    rows = make(random.Random(5), counters=True)
    found = metrics.rate_on_grid(spark.createDataFrame(rows, SCHEMA), SERIES, 300, 30).collect()
    got = {(r["metric"], r["instance"], r["at"]): r["value"] for r in found}
    expected = {}
    for key, points in folded(rows).items():
        for at in range(points[0][0] // (30 * SECOND), (points[-1][0] + 300 * SECOND) // (30 * SECOND) + 1):
            rate = brute_rate(points, at * 30 * SECOND, 300)
            if rate is not None:
                expected[(*key, at)] = rate
    assert got.keys() == expected.keys()
    assert all(math.isclose(got[k], expected[k], rel_tol=1e-9, abs_tol=1e-12) for k in got)


def test_one_busy_series_is_split_by_time(spark, plan_of):
    frame = spark.createDataFrame(make(random.Random(1)), SCHEMA)
    for df in (metrics.sample_spans(frame, SERIES), metrics.counter_rate(frame, SERIES), metrics.rate_on_grid(frame, SERIES)):
        plan = plan_of(df)
        windows = [line for line in plan.splitlines() if "Window [" in line]
        assert windows and all("slice#" in line for line in windows)
        assert "Join" not in plan


def test_ratio(spark):
    rows = [("n", "a", 1, 9.0), ("d", "a", 1, 10.0), ("n", "b", 1, 1.0), ("d", "c", 1, 1.0), ("n", "d", 1, 1.0), ("d", "d", 1, 0.0)]
    rows += [("n", "e", 1, 0.0), ("d", "e", 1, 0.0), ("other", "b", 1, 5.0)]
    found = metrics.ratio(spark.createDataFrame(rows, SCHEMA), "n", "d", ["ts_us", "instance"], 100.0)
    got = {r["instance"]: r["value"] for r in found.collect()}
    assert got.keys() == {"a", "d", "e"}
    assert got["a"] == 90.0 and got["d"] == math.inf and math.isnan(got["e"])


def test_status(spark):
    rows = [("up", "c", "a", 1, 1.0), ("up", "c", "a", 2, 0.0), ("up", "c", "b", 1, 0.0), ("up", "c", "b", 3, 1.0), ("x", "c", "b", 9, 0.0)]
    frame = spark.createDataFrame(rows, "metric string, cluster string, instance string, ts_us long, value double")
    got = {r["instance"]: r["status"] for r in metrics.status_latest(frame).collect()}
    assert got == {"a": "red", "b": "green"}


@pytest.mark.parametrize(
    "bean,name,kind,labels",
    [
        ("kafka.server<type=BrokerTopicMetrics, name=BytesInPerSec><>Count", "kafka_server_brokertopicmetrics_bytesin_total", "COUNTER", {}),
        ("kafka.server<type=BrokerTopicMetrics, name=BytesInPerSec><>OneMinuteRate", "kafka_server_brokertopicmetrics_bytesin_rate", "GAUGE", {}),
        ("kafka.server<type=X, name=IdlePercent><>Mean", "kafka_server_x_idle_mean", "GAUGE", {}),
        ("kafka.server<type=ReplicaManager, name=UnderReplicatedPartitions><>Value", "kafka_replica_manager_underreplicatedpartitions", "GAUGE", {}),
        ("kafka.network<type=A-b, name=c__d><>Value", "kafka_network_a_b_c_d", "GAUGE", {}),
        ("kafka.log<type=Log, name=Size, topic=t, partition=3><>Value", "kafka_log_size", "GAUGE", {"topic": "t", "partition": "3"}),
        ("kafka.server<type=BrokerTopicMetrics, name=BytesInPerSec, topic=t><>Count", None, None, None),
        ("java.lang<type=Memory><>HeapMemoryUsage", None, None, None),
        ("other<type=A, name=b><>Value", None, None, None),
    ],
)
def test_rename(spark, bean, name, kind, labels):
    row = metric_names.rename(spark.createDataFrame([(bean,)], "bean string")).first()
    assert (row and (row["name"], row["type"], row["labels"])) == (name and (name, kind, labels))


def test_rename_all_domains(spark):
    beans = ["java.lang<type=Memory><>HeapMemoryUsage", "java.lang<type=GarbageCollector, name=G1><>CollectionCount"]
    frame = spark.createDataFrame([(b,) for b in beans], "bean string")
    got = metric_names.rename(frame, domains=[]).orderBy("name").collect()
    assert [(r["name"], r["labels"]) for r in got] == [
        ("jvm_gc_collection_count", {"gc": "G1"}),
        ("jvm_memory_heap_bytes", {"area": "heap"}),
    ]
    assert metric_names.rename(frame).filter(F.lit(True)).count() == 0
