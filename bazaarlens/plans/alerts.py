"""Queries over alert rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import alerts
from ..operators.alerts import ALERT_RULES, Rule
from ..operators.metrics import at_instants
from . import metrics, views
from .views import with_cte

LABELS = alerts.LABELS
DOWN = ALERT_RULES[:1]
# One alert in two severities, which the shipped rules do not have, so that inhibition applies.
GRADED = [
    Rule("HandlersBusy", views.IDLE, "<", 22, 60, "warning"),
    Rule("HandlersBusy", views.IDLE, "<", 11, 30, "critical"),
    Rule("HandlersBusy", views.IDLE, "<", 6, 0, "page"),
    Rule("Down", "up", "==", 0, 60, "critical"),
    Rule("Replicas", views.REPLICAS, ">=", 2, 120, "info"),
]
REPEAT = 600


def _samples(spark: SparkSession, sf_dir: str, rules: list[Rule]) -> DataFrame:
    """The samples that the rules read, as far as the tables have them."""
    wanted = {r.metric for r in rules} | {r.per for r in rules if r.per}
    return views.samples(spark, sf_dir, *sorted(wanted & views.SOURCES.keys()))


def alert_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All shipped rules without their hold times."""
    found = at_instants(alerts.evaluate(_samples(spark, sf_dir, ALERT_RULES), ALERT_RULES))
    return found.select("alertname", *LABELS, "at", "value")


def alert_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = at_instants(alerts.evaluate(_samples(spark, sf_dir, DOWN), DOWN))
    return found.select("alertname", *LABELS, "at", "value")


def _runs(spark: SparkSession, sf_dir: str, rules: list[Rule]) -> DataFrame:
    return alerts.alert_runs(alerts.evaluate(_samples(spark, sf_dir, rules), rules))


def alert_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All shipped rules, each with its hold time."""
    found = _runs(spark, sf_dir, ALERT_RULES)
    return found.select("alertname", *LABELS, "start_at", "end_at", "fires_at", "state", "value")


def alert_annotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alerts.annotate(_runs(spark, sf_dir, ALERT_RULES), ALERT_RULES)
    return found.select("alertname", *LABELS, "start_at", "summary", "description")


def alert_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alerts.route(_runs(spark, sf_dir, GRADED))
    return found.select("alertname", "severity", *LABELS, "start_at", "receiver", "group_wait")


def alert_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.group(_runs(spark, sf_dir, GRADED).filter("state = 'firing'"))


def alert_inhibit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compared as stretches; instants are only written out for the result."""
    heard = alerts.firing_instants(alerts.inhibit_runs(_runs(spark, sf_dir, GRADED)))
    return heard.select("alertname", "severity", *LABELS, "at")


def alert_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.schedule(_runs(spark, sf_dir, GRADED), repeat=REPEAT)


def alert_notify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From rules to notices: alerts that are inhibited are neither grouped nor notified."""
    heard = alerts.inhibit_runs(_runs(spark, sf_dir, GRADED))
    return alerts.schedule(heard, repeat=REPEAT)


def _number(value: str) -> str:
    """The shortest digits; values of the shipped rules' alerts are below a million."""
    return f"regexp_replace(cast({value} as varchar), '\\.0$', '')"


SHIPPED = """
matches as (
  select 'KafkaBrokerDown' as alertname, 'critical' as severity, 60 as hold, job, cluster, instance, area, "at", value
    from on_grid where metric = 'up' and regexp_full_match(job, 'kafka-cluster-.*') and value = 0
  union all
  select 'KafkaBrokerUnderReplicatedPartitions', 'warning', 300, job, cluster, instance, area, "at", value
    from on_grid where metric = 'kafka_server_ReplicaManager_UnderReplicatedPartitions' and value > 0
  union all
  select 'KafkaBrokerRequestHandlerIdle', 'warning', 600, job, cluster, instance, area, "at", value
    from on_grid where metric = 'kafka_request_handler_AvgIdlePercent' and value < 10
  union all
  select 'KafkaBrokerOfflinePartitionsCount', 'critical', 60, job, cluster, instance, area, "at", value
    from on_grid where metric = 'kafka_server_ReplicaManager_OfflinePartitionsCount' and value > 0
  union all
  select 'KafkaBrokerActiveControllerCount', 'critical', 120, job, cluster, instance, area, "at", value
    from on_grid where metric = 'kafka_controller_KafkaController_ActiveControllerCount' and value = 0
  {more})
"""
HEAP = """
  union all
  select 'KafkajvmMemoryHigh', 'warning', 300, a.job, a.cluster, a.instance, a.area, a."at", a.value / b.value
    from on_grid a join on_grid b using (job, cluster, instance, area, "at")
   where a.metric = 'jvm_memory_heap_bytes' and b.metric = 'jvm_memory_heap_bytes_max'
     and area = 'heap' and a.value / b.value > 0.9
"""
LOW_RATE = """
  union all
  select 'KafkaBrokerProducerRequestRateLow', 'info', 900, job, cluster, instance, area, "at", rate
    from rates where rate < 100
"""
GRADED_MATCHES = """
matches as (
  select 'HandlersBusy' as alertname, 'warning' as severity, 60 as hold, job, cluster, instance, area, "at", value
    from on_grid where metric = 'kafka_request_handler_AvgIdlePercent' and value < 22
  union all
  select 'HandlersBusy', 'critical', 30, job, cluster, instance, area, "at", value
    from on_grid where metric = 'kafka_request_handler_AvgIdlePercent' and value < 11
  union all
  select 'HandlersBusy', 'page', 0, job, cluster, instance, area, "at", value
    from on_grid where metric = 'kafka_request_handler_AvgIdlePercent' and value < 6
  union all
  select 'Down', 'critical', 60, job, cluster, instance, area, "at", value
    from on_grid where metric = 'up' and value = 0
  union all
  select 'Replicas', 'info', 120, job, cluster, instance, area, "at", value
    from on_grid where metric = 'kafka_server_ReplicaManager_UnderReplicatedPartitions' and value >= 2)
"""
RUNS = """
islands as (
  select *, "at" - row_number() over (
    partition by alertname, severity, job, cluster, instance, area order by "at") as island
  from matches),
runs as (
  select alertname, severity, hold, job, cluster, instance, area, min("at") as start_at, max("at") as end_at,
         arg_max(value, "at") as value,
         case when max("at") - min("at") >= cast(ceil(hold / 30) as bigint)
              then min("at") + cast(ceil(hold / 30) as bigint) end as fires_at
  from islands group by alertname, severity, hold, job, cluster, instance, area, island)
"""
ROUTED = """
routed as (
  select *, case severity when 'critical' then 'critical' when 'warning' then 'warning' when 'info' then 'info'
            else 'default' end as receiver,
         case severity when 'critical' then 10 else 30 end as group_wait
  from runs)
"""
FIRING = """
firing as (
  select alertname, severity, job, cluster, instance, area, unnest(generate_series(fires_at, end_at)) as "at"
  from runs where fires_at is not null)
"""
# A group's looks are 300 s apart from its first notice on. The last look at or before a look at which an
# alert had joined decides: notices repeat from there.
NOTICES = f"""
stretches as (
  select receiver, group_wait, alertname, cluster, island, min("at") as lo, max("at") as hi,
         min("at") * 30 + group_wait as first_s, (max("at") + 1) * 30 - 1 as last_s
  from (select *, "at" - row_number() over (
          partition by receiver, group_wait, alertname, cluster order by "at") as island from present)
  group by receiver, group_wait, alertname, cluster, island),
looks as (
  select *, unnest(generate_series(0, (last_s - first_s) // 300)) as look from stretches where first_s <= last_s),
marks as (
  select distinct s.receiver, s.alertname, s.cluster, s.lo,
         greatest(0, cast(ceil((p."at" * 30 - s.first_s) / 300.0) as bigint)) as mark
  from stretches s join present p
    on p.joined and p.receiver = s.receiver and p.alertname = s.alertname and p.cluster = s.cluster
   and p."at" between s.lo and s.hi),
notices as (
  select l.receiver, l.alertname, l.cluster, l.first_s, l.look
  from looks l join marks m
    on m.receiver = l.receiver and m.alertname = l.alertname and m.cluster = l.cluster and m.lo = l.lo and m.mark <= l.look
  group by l.receiver, l.alertname, l.cluster, l.first_s, l.look
  having (l.look - max(m.mark)) % {-(-REPEAT // 300)} = 0)
"""
GRADED_RUNS = (views.SAMPLES, views.ON_GRID, GRADED_MATCHES, RUNS)

QUERIES = {
    "alert_down": (
        alert_down,
        with_cte(
            views.SAMPLES,
            views.ON_GRID,
            SHIPPED.format(more=""),
            body="""
select alertname, job, cluster, instance, area, "at", value from matches where alertname = 'KafkaBrokerDown'
""",
        ),
    ),
    "alert_threshold": (
        alert_threshold,
        with_cte(
            views.SAMPLES,
            views.ON_GRID,
            metrics.COUNTERS,
            metrics.GRID_WINDOWS,
            metrics.EXTRAPOLATED,
            SHIPPED.format(more=HEAP + LOW_RATE),
            body='select alertname, job, cluster, instance, area, "at", value from matches',
        ),
    ),
    "alert_for": (
        alert_for,
        with_cte(
            views.SAMPLES,
            views.ON_GRID,
            metrics.COUNTERS,
            metrics.GRID_WINDOWS,
            metrics.EXTRAPOLATED,
            SHIPPED.format(more=HEAP + LOW_RATE),
            RUNS,
            body="""
select alertname, job, cluster, instance, area, start_at, end_at, fires_at,
       case when fires_at is null then 'pending' else 'firing' end as state, value
from runs
""",
        ),
    ),
    "alert_annotate": (
        alert_annotate,
        with_cte(
            views.SAMPLES,
            views.ON_GRID,
            metrics.COUNTERS,
            metrics.GRID_WINDOWS,
            metrics.EXTRAPOLATED,
            SHIPPED.format(more=HEAP + LOW_RATE),
            RUNS,
            body=f"""
select alertname, job, cluster, instance, area, start_at,
  case alertname
    when 'KafkaBrokerDown' then 'Kafka broker is down (instance ' || instance || ')'
    when 'KafkaBrokerUnderReplicatedPartitions'
      then 'Kafka broker has under-replicated partitions (instance ' || instance || ')'
    when 'KafkaBrokerRequestHandlerIdle'
      then 'Kafka broker request handlers are overloaded (instance ' || instance || ')'
    when 'KafkaBrokerOfflinePartitionsCount' then 'Kafka broker has offline partitions (instance ' || instance || ')'
    when 'KafkaBrokerActiveControllerCount' then 'Kafka cluster has no active controller'
    when 'KafkaBrokerProducerRequestRateLow' then 'Low producer request rate (instance ' || instance || ')'
    else 'Kafka JVM heap memory usage high (instance ' || instance || ')' end as summary,
  case alertname
    when 'KafkaBrokerDown' then 'Kafka broker ' || instance || ' has been down for more than 1 minute.'
    when 'KafkaBrokerUnderReplicatedPartitions' then 'Broker ' || instance || ' has '
      || {_number("value")} || ' under-replicated partitions for more than 5 minutes.'
    when 'KafkaBrokerOfflinePartitionsCount' then 'Broker ' || instance || ' has ' || {_number("value")}
      || ' offline partitions for more than 1 minute.'
    when 'KafkaBrokerActiveControllerCount' then 'No active controller in Kafka cluster for more than 2 minutes.'
    when 'KafkaBrokerProducerRequestRateLow' then 'Broker ' || instance || ' producer request rate is low: '
      || {_number("value")} || ' bytes/sec for more than 15 minutes.'
    when 'KafkaBrokerRequestHandlerIdle' then 'Broker ' || instance || ' average idle percent is '
      || case when value = 0 then '0' else {_number("value")} end || '% for more than 10 minutes.'
    else 'Broker ' || instance || ' heap memory usage is '
      || regexp_replace(case when value >= 1 then printf('%.1f', value * 100) else printf('%.2f', value * 100) end,
                        '\\.?0+$', '') || '% for more than 5 minutes.' end as description
from runs
""",
        ),
    ),
    "alert_route": (
        alert_route,
        with_cte(
            *GRADED_RUNS,
            ROUTED,
            body="""
select alertname, severity, job, cluster, instance, area, start_at, receiver, group_wait from routed
""",
        ),
    ),
    "alert_group": (
        alert_group,
        with_cte(
            *GRADED_RUNS,
            body="""
select alertname, cluster, count(*) as alert_count, count(distinct instance) as instance_count,
       min(fires_at) as first_at, max(end_at) as last_at
from runs where fires_at is not null group by alertname, cluster
""",
        ),
    ),
    "alert_inhibit": (
        alert_inhibit,
        with_cte(
            *GRADED_RUNS,
            FIRING,
            body="""
select alertname, severity, job, cluster, instance, area, "at" from firing f
where not (f.severity = 'warning' and exists (
  select 1 from firing s where s.severity = 'critical' and s.alertname = f.alertname
     and s.cluster = f.cluster and s."at" = f."at"))
""",
        ),
    ),
    "alert_schedule": (
        alert_schedule,
        with_cte(
            *GRADED_RUNS,
            ROUTED,
            """
present as (
  select receiver, group_wait, alertname, cluster, "at", bool_or("at" = fires_at) as joined
  from (select *, unnest(generate_series(fires_at, end_at)) as "at" from routed where fires_at is not null)
  group by receiver, group_wait, alertname, cluster, "at")
""",
            NOTICES,
            body="select receiver, alertname, cluster, first_s + 300 * look as notify_s from notices",
        ),
    ),
    "alert_notify": (
        alert_notify,
        with_cte(
            *GRADED_RUNS,
            FIRING,
            """
heard as (
  select * from firing f
  where not (f.severity = 'warning' and exists (
    select 1 from firing s where s.severity = 'critical' and s.alertname = f.alertname
       and s.cluster = f.cluster and s."at" = f."at"))),
stepped as (
  select *, coalesce(lag("at") over (partition by alertname, severity, job, cluster, instance, area order by "at")
                     < "at" - 1, true) as joins
  from heard),
present as (
  select case when severity in ('critical', 'warning', 'info') then severity else 'default' end as receiver,
         case severity when 'critical' then 10 else 30 end as group_wait, alertname, cluster, "at",
         bool_or(joins) as joined
  from stepped group by all)
""",
            NOTICES,
            body="select receiver, alertname, cluster, first_s + 300 * look as notify_s from notices",
        ),
    ),
}
