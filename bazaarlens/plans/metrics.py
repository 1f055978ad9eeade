"""Queries over metric samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import metric_names
from ..operators import metrics
from . import views
from .views import with_cte

SERIES = ["metric", "job", "cluster", "instance", "area"]


def _beans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bean attributes, one kind per residue of the event id."""
    events = views.table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    what, user = F.initcap("event_type"), F.col("user_id").cast("string")
    kinds = [
        F.concat(F.lit("kafka.server<type=BrokerTopicMetrics, name="), what, F.lit("InPerSec><>Count")),
        F.concat(F.lit("kafka.server<type=BrokerTopicMetrics, name="), what, F.lit("PerSec><>OneMinuteRate")),
        F.concat(F.lit("kafka.server<type=Pool-"), user, F.lit(", name="), what, F.lit("IdlePercent><>Mean")),
        F.concat(F.lit("kafka.server<type=Pool, name="), what, F.lit("IdlePercentX><>50thPercentile")),
        F.concat(F.lit("kafka.server<type=Pool, name="), what, F.lit("Percent><>99thPercentile")),
        F.concat(F.lit("kafka.server<type=ReplicaManager, name="), what, F.lit("><>Value")),
        F.concat(F.lit("kafka.server<type=KafkaRequestHandlerPool, name="), what, F.lit("><>Value")),
        F.concat(F.lit("kafka.network<type=RequestChannel, name="), what, F.lit(" Queue><>Value")),
        F.concat(
            F.lit("kafka.log<type=Log, name=Size, topic="), F.col("event_type"), F.lit(", partition="), user, F.lit("><>Value")
        ),
        F.concat(F.lit("kafka.controller<type=KafkaController, name="), what, F.lit("Count><>Value")),
        F.lit("java.lang<type=Memory><>HeapMemoryUsage"),
        F.lit("java.lang<type=Memory><>NonHeapMemoryUsage"),
        F.concat(F.lit("java.lang<type=GarbageCollector, name=G"), user, F.lit("><>CollectionTime")),
        F.concat(F.lit("java.lang<type=GarbageCollector, name=G"), user, F.lit("><>CollectionCount")),
        F.concat(F.lit("kafka.server<type=Other, name="), what, F.lit("><>Value")),
    ]
    number = F.col("event_id") % len(kinds)
    bean = F.coalesce(*[F.when(number == i, kind) for i, kind in enumerate(kinds)])
    return events.select("event_id", bean.alias("bean"))


def _renamed(spark: SparkSession, sf_dir: str, domains: list[str] | None) -> DataFrame:
    rows = metric_names.rename(_beans(spark, sf_dir), domains=domains)
    labels = F.array_sort(F.map_entries("labels"))
    return rows.select(
        "event_id",
        "name",
        "type",
        F.array_join(F.transform(labels, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("labels"),
    )


def metric_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _renamed(spark, sf_dir, None)


def metric_rename_all_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _renamed(spark, sf_dir, [])


def metric_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.sample_on_grid(views.samples(spark, sf_dir), SERIES)


def rate_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    counters = views.samples(spark, sf_dir, views.BYTES_IN)
    return metrics.counter_rate(counters, SERIES)


def rate_5m_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    counters = views.samples(spark, sf_dir, views.BYTES_IN)
    return metrics.counter_rate(counters, SERIES, extrapolate=False)


def rate_on_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    counters = views.samples(spark, sf_dir, views.BYTES_IN)
    return metrics.rate_on_grid(counters, SERIES)


def alert_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    heap = views.samples(spark, sf_dir, views.HEAP, views.HEAP_MAX).filter("area = 'heap'")
    keys = ["ts_us", "job", "cluster", "instance", "area"]
    return metrics.ratio(heap, views.HEAP, views.HEAP_MAX, keys)


def heap_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    heap = views.samples(spark, sf_dir, views.HEAP, views.HEAP_MAX).filter("area = 'heap'")
    keys = ["ts_us", "job", "cluster", "instance", "area"]
    return metrics.ratio(heap, views.HEAP, views.HEAP_MAX, keys, scale=100.0)


def status_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.status_latest(views.samples(spark, sf_dir, "up"))


def metric_sample_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.samples(spark, sf_dir).groupBy("metric", "cluster").agg(F.count("*").alias("samples"))


def metric_sample_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples with their labels in a map, as they are scraped, turned into label columns."""
    found = views.samples(spark, sf_dir)
    pair = F.create_map(
        F.lit("area"), F.col("area"), F.lit("topic"), (F.col("event_id") % 3).cast("string"), F.lit("le"), F.lit("1")
    )
    scraped = found.select(
        F.timestamp_micros("ts_us").alias("ts"), "metric", "job", "cluster", "instance", pair.alias("labels"), "value"
    )
    return metrics.from_labels(scraped.to(schemas.METRIC_SAMPLE), ["job", "cluster", "instance", "area"])


BEANS = """
named as (
  select event_id, event_id % 15 as k, event_type as low, cast(user_id as varchar) as u from events),
renamed as (
  select event_id, k,
    case k
      when 0 then 'kafka_server_brokertopicmetrics_' || low || 'in_total'
      when 1 then 'kafka_server_brokertopicmetrics_' || low || '_rate'
      when 2 then 'kafka_server_pool_' || u || '_' || low || 'idle_mean'
      when 3 then 'kafka_server_pool_' || low || 'idle_50th_percentile'
      when 4 then 'kafka_server_pool_' || low || '_99th_percentile'
      when 5 then 'kafka_replica_manager_' || low
      when 6 then 'kafka_request_handler_' || low
      when 7 then 'kafka_network_requestchannel_' || low || '_queue'
      when 8 then 'kafka_log_size'
      when 9 then 'kafka_controller_kafkacontroller_' || low || 'count'
      when 10 then 'jvm_memory_heap_bytes'
      when 11 then 'jvm_memory_nonheap_bytes'
      when 12 then 'jvm_gc_collection_time_seconds'
      when 13 then 'jvm_gc_collection_count' end as name,
    case when k = 0 then 'COUNTER' when k >= 10 then 'UNTYPED' else 'GAUGE' end as type,
    case k when 8 then 'partition=' || u || ',topic=' || low when 10 then 'area=heap'
      when 11 then 'area=nonheap' when 12 then 'gc=G' || u when 13 then 'gc=G' || u else '' end as labels
  from named)
"""
COUNTERS = """
counters as (
  select *, lag(value) over (partition by metric, job, cluster, instance, area order by ts_us) as before
  from samples where metric = 'kafka_server_BrokerTopicMetrics_BytesInPerSec_total'),
drops as (select *, case when value < before then before else 0 end as lost from counters)
"""
WINDOWED = """
windowed as (
  select metric, job, cluster, instance, area, ts_us, ts_us as to_us, value as last_value, ts_us as last_us,
         count(*) over w as n, first_value(ts_us) over w as first_us, first_value(value) over w as first_value,
         sum(lost) over w - first_value(lost) over w as lost
  from drops
  window w as (partition by metric, job, cluster, instance, area order by ts_us
               range between 300000000 preceding and current row))
"""
EXTRAPOLATED = """
spans as (
  select *, last_value - first_value + lost as increase, cast(last_us - first_us as double) as covered,
         cast(first_us - (to_us - 300000000) as double) as head0, cast(to_us - last_us as double) as tail0
  from windowed where n > 1),
limited as (
  select *, covered / (n - 1) as gap,
         case when increase > 0 and first_value >= 0 and covered * (first_value / increase) < head0
              then covered * (first_value / increase) else head0 end as head1
  from spans),
ends as (
  select *, case when head1 >= gap * 1.1 then gap / 2 else head1 end as head,
         case when tail0 >= gap * 1.1 then gap / 2 else tail0 end as tail
  from limited),
rates as (
  select *, increase * ((covered + head + tail) / covered) / cast(300 as double) as rate from ends)
"""
GRID_WINDOWS = """
reached as (
  select d.metric, d.job, d.cluster, d.instance, d.area, d.ts_us, d.value, d.lost, g."at"
  from drops d, (select unnest(generate_series(lo, hi)) as "at" from
                 (select min(ts_us) // 30000000 as lo, (max(ts_us) + 300000000) // 30000000 as hi from samples)) g
  where g."at" * 30000000 >= d.ts_us and g."at" * 30000000 - 300000000 <= d.ts_us),
windowed as (
  select metric, job, cluster, instance, area, "at", "at" * 30000000 as to_us,
         arg_max(value, ts_us) as last_value, max(ts_us) as last_us, count(*) as n,
         min(ts_us) as first_us, arg_min(value, ts_us) as first_value,
         sum(lost) - arg_min(lost, ts_us) as lost
  from reached group by all)
"""
RATIO = """
select ts_us, job, cluster, instance, area,
       max(value) filter (metric = 'jvm_memory_heap_bytes')
       / max(value) filter (metric = 'jvm_memory_heap_bytes_max') {scale} as value
from samples where area = 'heap' group by ts_us, job, cluster, instance, area
"""

QUERIES = {
    "metric_rename": (
        metric_rename,
        with_cte(BEANS, body="select event_id, name, type, labels from renamed where k < 10"),
    ),
    "metric_rename_all_domains": (
        metric_rename_all_domains,
        with_cte(BEANS, body="select event_id, name, type, labels from renamed where k < 14"),
    ),
    "metric_sample_labels": (
        metric_sample_labels,
        with_cte(
            views.SAMPLES,
            body="""
select metric, job, cluster, instance, area, 'le=1,topic=' || event_id % 3 as other_labels, ts_us, value from samples
""",
        ),
    ),
    "metric_sample_counts": (
        metric_sample_counts,
        with_cte(
            views.SAMPLES, body="select metric, cluster, count(*) as samples from samples group by metric, cluster"
        ),
    ),
    "metric_asof": (
        metric_asof,
        with_cte(
            views.SAMPLES,
            views.ON_GRID,
            body='select metric, job, cluster, instance, area, "at", value from on_grid',
        ),
    ),
    "rate_5m": (
        rate_5m,
        with_cte(
            views.SAMPLES,
            COUNTERS,
            WINDOWED,
            EXTRAPOLATED,
            body="select metric, job, cluster, instance, area, ts_us, n as samples, rate from rates",
        ),
    ),
    "rate_5m_plain": (
        rate_5m_plain,
        with_cte(
            views.SAMPLES,
            COUNTERS,
            WINDOWED,
            body="""
select metric, job, cluster, instance, area, ts_us, n as samples,
       (last_value - first_value + lost) / cast(300 as double) as rate
from windowed where n > 1
""",
        ),
    ),
    "rate_on_grid": (
        rate_on_grid,
        with_cte(
            views.SAMPLES,
            COUNTERS,
            GRID_WINDOWS,
            EXTRAPOLATED,
            body='select metric, job, cluster, instance, area, "at", rate as value from rates',
        ),
    ),
    "alert_ratio": (alert_ratio, with_cte(views.SAMPLES, body=RATIO.format(scale=""))),
    "heap_percent": (heap_percent, with_cte(views.SAMPLES, body=RATIO.format(scale="* 100"))),
    "status_latest": (
        status_latest,
        with_cte(
            views.SAMPLES,
            body="""
select cluster, instance, max(ts_us) as ts_us, arg_max(value, ts_us) as value,
       case when arg_max(value, ts_us) < 1 then 'red' else 'green' end as status
from samples where metric = 'up' group by cluster, instance
""",
        ),
    ),
}
