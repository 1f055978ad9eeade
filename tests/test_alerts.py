import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from bazaarlens.operators import alerts, metrics
from bazaarlens.operators.alerts import ALERT_RULES, Rule

SECOND = metrics.SECOND
START = 1_704_067_200 * SECOND
SAMPLES = "metric string, job string, cluster string, instance string, area string, ts_us long, value double"
RUN = "k string, from_at long, to_at long, value double, starts boolean"


def brute_runs(instants):
    """(start, end, value, continues) of consecutive instants; ``instants``: {at: (value, starts)}."""
    out = []
    for at in sorted(instants):
        value, starts = instants[at]
        adjacent = bool(out) and out[-1][1] == at - 1
        if adjacent and not starts:
            out[-1] = (out[-1][0], at, value, out[-1][3])
        else:
            out.append((at, at, value, bool(starts and adjacent)))
    return out


@pytest.mark.parametrize("slice_steps", [1, 2, 5, 16, 1000])
@pytest.mark.parametrize("seed", [1, 2])
def test_runs(spark, slice_steps, seed):
    rng = random.Random(seed)
    rows, expected = [], {}
    for key, density, forced in [("a", 0.9, 0.0), ("b", 0.5, 0.2), ("c", 1.0, 0.0), ("d", 1.0, 0.3), ("e", 0.1, 0.5)]:
        instants = {at: (float(at), rng.random() < forced) for at in range(100, 180) if rng.random() < density}
        rows += [(key, at, at, value, starts) for at, (value, starts) in instants.items()]
        expected[key] = brute_runs(instants)
    rng.shuffle(rows)
    found = alerts.runs(spark.createDataFrame(rows, RUN), ["k"], slice_steps, starts="starts").collect()
    for key, runs in expected.items():
        got = sorted((r["start_at"], r["end_at"], r["value"], r["continues"]) for r in found if r["k"] == key)
        assert got == runs, (key, slice_steps)


def test_runs_of_spans(spark):
    rows = [("k", 0, 3, 1.0, None), ("k", 4, 4, 2.0, None), ("k", 5, 9, 3.0, None), ("k", 10, 12, 4.0, None), ("k", 14, 15, 5.0, None)]
    found = alerts.runs(spark.createDataFrame(rows, RUN), ["k"], 5).orderBy("start_at").collect()
    assert [(r["start_at"], r["end_at"], r["value"]) for r in found] == [(0, 12, 4.0), (14, 15, 5.0)]


def test_steady_alerts_meet_only_at_slice_borders(spark, plan_of):
    rows = spark.range(0, 20_000).selectExpr("'k' as k", "id as from_at", "id as to_at", "1D as value", "false as starts")
    found = alerts.runs(rows, ["k"], 100)
    assert [tuple(r)[:3] for r in found.select("k", "start_at", "end_at").collect()] == [("k", 0, 19_999)]
    windows = [line for line in plan_of(found).splitlines() if "Window [" in line]
    assert windows and all("slice#" in line or "meeting#" in line for line in windows)


def sample(metric, instance, at_s, value, job="kafka-cluster-1", cluster="cluster-1", area=""):
    return (metric, job, cluster, instance, area, START + at_s * SECOND, float(value))


def evaluated(spark, rows, rules, step=30):
    return alerts.evaluate(spark.createDataFrame(rows, SAMPLES), rules, step=step)


def test_broker_down_holds_one_minute(spark):
    rows = [sample("up", "a", t, 0) for t in range(0, 120, 15)] + [sample("up", "a", 120, 1)]
    rows += [sample("up", "b", t, 0) for t in range(0, 45, 15)] + [sample("up", "b", 45, 1)]
    rows += [sample("up", "c", t, 0, job="prometheus") for t in range(0, 600, 15)]
    rows += [sample("up", "d", t, 0, job="xkafka-cluster-1") for t in range(0, 600, 15)]
    found = alerts.alert_runs(evaluated(spark, rows, ALERT_RULES[:1])).orderBy("instance").collect()
    base = START // SECOND // 30
    got = [(r["instance"], r["start_at"] - base, r["end_at"] - base, r["fires_at"] and r["fires_at"] - base, r["state"]) for r in found]
    assert got == [("a", 0, 3, 2, "firing"), ("b", 0, 1, None, "pending")]
    assert {(r["alertname"], r["severity"], r["team"], r["hold"]) for r in found} == {("KafkaBrokerDown", "critical", "kafka", 60)}


def test_hold_is_rounded_up_to_the_grid(spark):
    rows = [sample("up", "a", t, 0) for t in range(0, 100, 10)]
    rule = Rule("X", "up", "==", 0, 45, "info")
    run = alerts.alert_runs(evaluated(spark, rows, [rule])).first()
    assert run["fires_at"] - run["start_at"] == 2


def test_shipped_rules_with_ratio_and_rate(spark):
    rows = []
    for t in range(0, 3600, 15):
        rows.append(sample("jvm_memory_heap_bytes", "a", t, 95, area="heap"))
        rows.append(sample("jvm_memory_heap_bytes_max", "a", t, 100, area="heap"))
        rows.append(sample("jvm_memory_heap_bytes", "a", t, 99, area="nonheap"))
        rows.append(sample("jvm_memory_heap_bytes_max", "a", t, 100, area="nonheap"))
        rows.append(sample("jvm_memory_heap_bytes", "b", t, 50, area="heap"))
        rows.append(sample("jvm_memory_heap_bytes_max", "b", t, 100, area="heap"))
        rows.append(sample("kafka_server_BrokerTopicMetrics_BytesInPerSec_total", "a", t, t * 99))
        rows.append(sample("kafka_server_BrokerTopicMetrics_BytesInPerSec_total", "b", t, t * 101))
        rows.append(sample("kafka_request_handler_AvgIdlePercent", "a", t, 9.5 if t < 1800 else 10))
        rows.append(sample("kafka_server_ReplicaManager_OfflinePartitionsCount", "a", t, math.nan))
        rows.append(sample("kafka_controller_KafkaController_ActiveControllerCount", "a", t, 0))
    found = alerts.alert_runs(evaluated(spark, rows, ALERT_RULES)).collect()
    firing = {(r["alertname"], r["instance"], r["area"]) for r in found if r["state"] == "firing"}
    assert firing == {
        ("KafkajvmMemoryHigh", "a", "heap"),
        ("KafkaBrokerProducerRequestRateLow", "a", ""),
        ("KafkaBrokerRequestHandlerIdle", "a", ""),
        ("KafkaBrokerActiveControllerCount", "a", ""),
    }


ALERTS = (
    "alertname string, severity string, team string, hold int, job string, cluster string, instance string,"
    " area string, start_at long, end_at long, fires_at long, state string, value double"
)


def alert(name, severity, instance, fires, end, cluster="c", state="firing", value=1.0):
    return (name, severity, "kafka", 0, "j", cluster, instance, "", fires - 1, end, fires, state, value)


def test_routing(spark):
    rows = [alert("x", s, "i", 5, 9) for s in ("critical", "warning", "info", "page")]
    got = {r["severity"]: (r["receiver"], r["group_wait"]) for r in alerts.route(spark.createDataFrame(rows, ALERTS)).collect()}
    assert got == {"critical": ("critical", 10), "warning": ("warning", 30), "info": ("info", 30), "page": ("default", 30)}


def test_groups(spark):
    rows = [alert("x", "critical", "a", 5, 9), alert("x", "critical", "a", 12, 20), alert("x", "critical", "b", 4, 6), alert("x", "critical", "a", 5, 9, "d")]
    got = sorted(map(tuple, alerts.group(spark.createDataFrame(rows, ALERTS)).collect()))
    assert got == [("x", "c", 3, 2, 4, 20), ("x", "d", 1, 1, 5, 9)]


def test_inhibition(spark):
    rows = [
        alert("x", "critical", "a", 5, 7),
        alert("x", "warning", "b", 4, 9),
        alert("x", "warning", "b", 4, 9, cluster="d"),
        alert("y", "warning", "b", 5, 6),
        alert("x", "info", "b", 5, 6),
        alert("x", "critical", "z", 8, 9, state="pending"),
    ]
    left = alerts.inhibit(alerts.firing_instants(spark.createDataFrame(rows, ALERTS)))
    warned = sorted((r["alertname"], r["cluster"], r["at"]) for r in left.filter("severity = 'warning'").collect())
    expected = [("x", "c", 4), ("x", "c", 8), ("x", "c", 9)] + [("x", "d", at) for at in range(4, 10)] + [("y", "c", 5), ("y", "c", 6)]
    assert warned == sorted(expected)
    assert left.filter("severity = 'critical'").count() == 3 and left.filter("severity = 'info'").count() == 2


def test_missing_labels_inhibit_each_other(spark):
    rows = [alert("x", "critical", "a", 5, 7, cluster=None), alert("x", "warning", "b", 4, 9, cluster=None)]
    frame = spark.createDataFrame(rows, ALERTS)
    left = alerts.inhibit(alerts.firing_instants(frame)).filter("severity = 'warning'")
    assert sorted(r["at"] for r in left.collect()) == [4, 8, 9]
    runs = alerts.inhibit_runs(frame).filter("severity = 'warning'").collect()
    assert sorted((r["fires_at"], r["end_at"]) for r in runs) == [(4, 4), (8, 9)]


def test_inhibited_stretches_are_the_inhibited_instants(spark):
    rng = random.Random(6)
    rows = []
    for instance in "abcdef":
        at = rng.randrange(alerts.SLICE)
        for _ in range(12):
            end = at + rng.randrange(1, alerts.SLICE // 3)
            rows.append(alert("x", rng.choice(["critical", "warning", "info"]), instance, at, end))
            at = end + rng.randrange(2, 900)
    frame = spark.createDataFrame(rows, ALERTS)
    want = alerts.inhibit(alerts.firing_instants(frame)).select("severity", "instance", "at").collect()
    got = alerts.firing_instants(alerts.inhibit_runs(frame)).select("severity", "instance", "at").collect()
    assert sorted(map(tuple, got)) == sorted(set(map(tuple, want)))


def brute_notices(rows, wait, repeat, interval=300, step=30):
    """Look by look, from the rule: rows are (fires_at, end_at) of one group."""
    present = {at for a, b in rows for at in range(a, b + 1)}
    out, at = [], min(present)
    while at <= max(present):
        if at not in present or at - 1 in present:
            at += 1
            continue
        end = at
        while end + 1 in present:
            end += 1
        look, told, seen = at * step + wait, None, None
        while look <= (end + 1) * step - 1:
            joined = [a for a, _ in rows if at <= a <= end and (seen is None or a * step > seen) and a * step <= look]
            if joined or look - told >= repeat:
                out.append(look)
                told = look
            seen, look = look, look + interval
        at = end + 1
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_schedule_look_by_look(spark, seed):
    rng = random.Random(seed)
    rows, at = [], alerts.SLICE - 400
    for k in range(30):
        at += rng.randrange(40)
        rows.append((f"i{k}", at, at + rng.randrange(1, 60)))
    frame = [alert("x", "warning", i, a, b) for i, a, b in rows]
    want = brute_notices([(a, b) for _, a, b in rows], 30, 700)
    assert times(spark, frame, repeat=700) == [("warning", t) for t in want]


def test_no_rules_give_no_alerts(spark):
    rows = [sample("up", "i", 0, 0.0)]
    assert alerts.evaluate(spark.createDataFrame(rows, SAMPLES), []).count() == 0


def test_shipped_rules_are_never_inhibited():
    for a, b in itertools.combinations(ALERT_RULES, 2):
        assert a.alertname != b.alertname


def times(spark, rows, repeat=alerts.REPEAT_INTERVAL):
    found = alerts.schedule(spark.createDataFrame(rows, ALERTS), repeat=repeat)
    return sorted((r["receiver"], r["notify_s"]) for r in found.collect())


def test_schedule(spark):
    hour = 120
    assert times(spark, [alert("x", "critical", "a", 10, 10 + 25 * hour)]) == [
        ("critical", 310),
        ("critical", 310 + 43200),
        ("critical", 310 + 86400),
    ]
    # Too short for the wait; then a second alert that joins, and a gap that starts anew.
    assert times(spark, [alert("x", "warning", "a", 10, 10)]) == []
    # The wait counts from the group's start, whoever joins meanwhile.
    at_once = [alert("x", "warning", "a", 10, 11), alert("x", "warning", "b", 11, 11)]
    assert times(spark, at_once) == [("warning", 330)]
    # A group that others keep joining is notified at each look.
    joining = [alert("x", "warning", f"i{k}", 10 + 5 * k, 100) for k in range(12)]
    assert times(spark, joining) == [("warning", 330 + 300 * k) for k in range(7)]
    joined = [alert("x", "warning", "a", 10, 40), alert("x", "warning", "b", 20, 50), alert("x", "warning", "b", 52, 60)]
    assert times(spark, joined) == [("warning", 330), ("warning", 630), ("warning", 1590)]
    assert times(spark, [alert("x", "info", "a", 10, 40)], repeat=600) == [("info", 330), ("info", 930)]
    assert times(spark, [alert("x", "info", "a", 10, 40, state="pending")]) == []


@pytest.mark.parametrize(
    "value,plain,share",
    [
        (5.0, "5", "500%"),
        (0.25, "0.25", "25%"),
        (0.0, "0", "0%"),
        (0.95123, "0.95123", "95.12%"),
        (0.0012346, "0.0012346", "0.1235%"),
        (1.0, "1", "100%"),
        (12345678.0, "1.2345678e+07", None),
        (1 / 60, "0.016666666666666666", "1.667%"),
        (1e-5, "1e-05", "0.001%"),
        (1e-4, "0.0001", "0.01%"),
        (123456.0, "123456", "1.235e+07%"),
        (1e6, "1e+06", "1e+08%"),
        (1e22, "1e+22", "1e+24%"),
        (1e300, "1e+300", "1e+302%"),
        (99.9999, "99.9999", "1e+04%"),
        (-2.5e-7, "-2.5e-07", "-2.5e-05%"),
        (99.991, "99.991", "9999%"),
        (-3.5, "-3.5", "-350%"),
        (math.inf, "+Inf", "+Inf%"),
        (math.nan, "NaN", "NaN%"),
    ],
)
def test_numbers_in_annotations(spark, value, plain, share):
    row = spark.createDataFrame([(value,)], "value double").select(
        alerts.plain_number(F.col("value")), alerts.percentage(F.col("value"))
    ).first()
    assert row[0] == plain
    assert share is None or row[1] == share


def test_annotations(spark):
    rows = [
        ("KafkaBrokerDown", "critical", "kafka-0:7071", 0.0),
        ("KafkaBrokerUnderReplicatedPartitions", "warning", "kafka-0:7071", 3.0),
        ("KafkajvmMemoryHigh", "warning", "kafka-1:7071", 0.93),
        ("KafkaBrokerRequestHandlerIdle", "warning", "kafka-1:7071", 9.5),
    ]
    frame = spark.createDataFrame(rows, "alertname string, severity string, instance string, value double")
    got = {r["alertname"]: (r["summary"], r["description"]) for r in alerts.annotate(frame, ALERT_RULES).collect()}
    assert got["KafkaBrokerDown"] == (
        "Kafka broker is down (instance kafka-0:7071)",
        "Kafka broker kafka-0:7071 has been down for more than 1 minute.",
    )
    assert got["KafkaBrokerUnderReplicatedPartitions"][1].startswith("Broker kafka-0:7071 has 3 under-replicated")
    assert got["KafkajvmMemoryHigh"][1] == "Broker kafka-1:7071 heap memory usage is 93% for more than 5 minutes."
    assert "idle percent is 9.5% for" in got["KafkaBrokerRequestHandlerIdle"][1]
    with pytest.raises(ValueError):
        alerts.fill("{{ $externalLabels.x }}")
