"""The engine's inputs, derived from the given tables; each Spark view has its SQL twin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsontext import first_case

BASE_US = 1_704_067_200_000_000  # 2024-01-01 00:00:00 UTC


# The tables the queries read. A stated schema saves the job that would read it from a file.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def with_cte(*ctes: str, body: str) -> str:
    return "with " + ",\n".join(c.strip() for c in ctes) + "\n" + body.strip()


def searches_of(events: DataFrame, parts: DataFrame) -> DataFrame:
    """Search events: each event searches for one part, some with a longer term, some for nothing."""
    keyed = events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        (F.col("event_id") % parts.agg(F.count("*")).scalar()).alias("p_partkey"),
    )
    longer = F.concat("p_name", F.lit(" "), F.lower("p_type"))
    term = F.when(F.col("event_id") % 2 == 0, F.col("p_name")).otherwise(longer)
    searched = F.col("event_type") != "error"
    return keyed.join(parts.select("p_partkey", "p_name", "p_type"), "p_partkey").select(
        "event_id",
        "ts",
        "user_id",
        F.when(searched, F.col("p_name")).alias("product_name"),
        F.when(searched, term).alias("term"),
    )


def ordered_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A search per order line: the part's name and the order."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_orderkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    term = F.concat("p_name", F.lit(" "), F.col("l_orderkey").cast("string"))
    return lines.join(parts, "p_partkey").select(term.alias("product_name"))


def searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return searches_of(table(spark, sf_dir, "events"), table(spark, sf_dir, "part"))


SEARCHES = """
searches as (
  select e.event_id, e.ts, e.user_id,
         case when e.event_type <> 'error' then p.p_name end as product_name,
         case when e.event_type <> 'error' then
           case when e.event_id % 2 = 0 then p.p_name else p.p_name || ' ' || lower(p.p_type) end
         end as term
  from events e join part p on p.p_partkey = e.event_id % (select count(*) from part))
"""
RANKED = """
ranked as (
  select row_number() over (order by count(*) desc, product_name) as rank,
         product_name, count(*) as search_count
  from searches where product_name is not null group by product_name)
"""
POPULAR = "popular as (select * from ranked where rank <= 10)"


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as nested catalog products."""
    part = table(spark, sf_dir, "part")
    pid = F.col("p_partkey").cast("string")
    return part.select(
        pid.alias("product_id"),
        F.col("p_name").alias("name"),
        F.concat(F.col("p_brand"), F.lit(" "), F.col("p_name")).alias("description"),
        F.struct(F.col("p_retailprice").alias("amount"), F.lit("RUB").alias("currency")).alias("price"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.struct(F.col("p_size").alias("available"), (F.col("p_size") % 5).alias("reserved")).alias("stock"),
        F.concat(F.lit("SKU-"), pid).alias("sku"),
        F.split("p_name", " ").alias("tags"),
        F.when(
            F.col("p_size") % 4 != 0,
            F.array(
                F.struct(F.concat(F.lit("https://img.example/"), pid).alias("url"), F.col("p_name").alias("alt")),
            ),
        ).alias("images"),
        F.create_map(F.lit("size"), F.col("p_size").cast("string"), F.lit("type"), F.col("p_type")).alias(
            "specifications"
        ),
        F.lit("2024-01-01T00:00:00Z").alias("created_at"),
        F.lit(None).cast("string").alias("updated_at"),
        F.lit("products").alias("index"),
        F.concat(F.lit("store_"), (F.col("p_partkey") % 7).cast("string")).alias("store_id"),
    )


def allowed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that were ordered fifty at a time, returned, at the highest discount."""
    rows = table(spark, sf_dir, "lineitem").filter(
        "l_quantity = 50 and l_returnflag = 'R' and l_discount = cast(0.1 as double)"
    )
    return rows.select(F.col("l_partkey").cast("string").alias("product_id")).distinct()


ALLOWED = """
allowed as (
  select distinct cast(l_partkey as varchar) as product_id from lineitem
  where l_quantity = 50 and l_returnflag = 'R' and l_discount = cast(0.1 as double))
"""


def routed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A longer list, so that every route of the catalog filter occurs."""
    rows = table(spark, sf_dir, "lineitem").filter("l_quantity = 50 and l_returnflag = 'R'")
    return rows.select(F.col("l_partkey").cast("string").alias("product_id")).distinct()


ROUTED = """
routed as (
  select distinct cast(l_partkey as varchar) as product_id from lineitem
  where l_quantity = 50 and l_returnflag = 'R')
"""


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as topic messages, a topic per event type."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("props").alias("value"),
    )


MESSAGES = """
messages as (
  select event_type as topic, cast(user_id % 3 as integer) as "partition", event_id as "offset",
         props as value
  from events)
"""


IDLE = "kafka_request_handler_AvgIdlePercent"
REPLICAS = "kafka_server_ReplicaManager_UnderReplicatedPartitions"
OFFLINE = "kafka_server_ReplicaManager_OfflinePartitionsCount"
CONTROLLER = "kafka_controller_KafkaController_ActiveControllerCount"
HEAP, HEAP_MAX = "jvm_memory_heap_bytes", "jvm_memory_heap_bytes_max"
BYTES_IN = "kafka_server_BrokerTopicMetrics_BytesInPerSec_total"
# Which events carry which metrics.
SOURCES = {
    "up": "error",
    OFFLINE: "error",
    REPLICAS: "view",
    CONTROLLER: "view",
    HEAP: "click",
    HEAP_MAX: "click",
    IDLE: "purchase",
    BYTES_IN: "signup",
}


def _sample_values() -> dict[str, tuple[Column, str]]:
    """Metric to value and area."""
    raw, user = F.col("value"), F.col("user_id")
    phase = F.expr("event_id div 800 + user_id")
    return {
        "up": (F.when(phase % 3 == 0, F.lit(0)).otherwise(F.lit(1)), ""),
        OFFLINE: (phase % 7 % 3, ""),
        REPLICAS: (phase % 4, ""),
        CONTROLLER: (F.when(phase % 5 < 2, F.lit(0)).otherwise(F.lit(1)), ""),
        HEAP: (F.round(raw * 10) % 1000, "heap"),
        HEAP_MAX: (F.lit(900) + user % 7 * 20, "heap"),
        IDLE: (F.round(raw * 10) % 30 + phase % 3 * 4, ""),
        BYTES_IN: ((F.col("event_id") % 5000) * (user % 4) * 200, ""),
    }


def samples_of(events: DataFrame, *metrics: str) -> DataFrame:
    """Broker metrics: events as scrapes, 1.5 s apart, of 32 brokers in two clusters.

    With ``metrics`` only those, and only the events that carry them are read.
    """
    values = {name: v for name, v in _sample_values().items() if not metrics or name in metrics}
    kinds = sorted({SOURCES[name] for name in values})
    found = []
    for kind in kinds:
        carried = [
            F.struct(F.lit(name).alias("metric"), F.lit(area).alias("area"), value.cast("double").alias("value"))
            for name, (value, area) in values.items()
            if SOURCES[name] == kind
        ]
        found.append((F.col("event_type") == kind, F.array(*carried)))
    side = (F.col("user_id") % 2 + 1).cast("string")
    return (
        events.filter(F.col("event_type").isin(kinds))
        .select(
            "event_id",
            (F.lit(BASE_US) + F.col("event_id") * 1_500_000).alias("ts_us"),
            F.when(F.col("user_id") % 32 == 31, F.lit("prometheus"))
            .otherwise(F.concat(F.lit("kafka-cluster-"), side))
            .alias("job"),
            F.concat(F.lit("cluster-"), side).alias("cluster"),
            F.concat(F.lit("broker-"), (F.col("user_id") % 32).cast("string")).alias("instance"),
            F.explode(first_case(found)).alias("sample"),
        )
        .select("event_id", "ts_us", "job", "cluster", "instance", "sample.*")
    )


def samples(spark: SparkSession, sf_dir: str, *metrics: str) -> DataFrame:
    return samples_of(table(spark, sf_dir, "events"), *metrics)


SAMPLES = f"""
scrapes as (
  select event_id, user_id, event_type, value as raw, event_id // 800 + user_id as phase,
         {BASE_US} + event_id * 1500000 as ts_us,
         case when user_id % 32 = 31 then 'prometheus'
              else 'kafka-cluster-' || cast(user_id % 2 + 1 as varchar) end as job,
         'cluster-' || cast(user_id % 2 + 1 as varchar) as cluster,
         'broker-' || cast(user_id % 32 as varchar) as instance
  from events),
samples as (
  select event_id, ts_us, job, cluster, instance, metric, area, cast(value as double) as value from (
    select *, 'up' as metric, '' as area, cast(case when phase % 3 = 0 then 0 else 1 end as double) as value
      from scrapes where event_type = 'error'
    union all
    select *, 'kafka_server_ReplicaManager_UnderReplicatedPartitions', '', cast(phase % 4 as double)
      from scrapes where event_type = 'view'
    union all
    select *, 'kafka_server_ReplicaManager_OfflinePartitionsCount', '', cast(phase % 7 % 3 as double)
      from scrapes where event_type = 'error'
    union all
    select *, 'kafka_controller_KafkaController_ActiveControllerCount', '',
           cast(case when phase % 5 < 2 then 0 else 1 end as double)
      from scrapes where event_type = 'view'
    union all
    select *, 'jvm_memory_heap_bytes', 'heap', round(raw * 10) % 1000
      from scrapes where event_type = 'click'
    union all
    select *, 'jvm_memory_heap_bytes_max', 'heap', cast(900 + user_id % 7 * 20 as double)
      from scrapes where event_type = 'click'
    union all
    select *, 'kafka_request_handler_AvgIdlePercent', '', round(raw * 10) % 30 + phase % 3 * 4
      from scrapes where event_type = 'purchase'
    union all
    select *, 'kafka_server_BrokerTopicMetrics_BytesInPerSec_total', '',
           cast(event_id % 5000 * (user_id % 4) * 200 as double)
      from scrapes where event_type = 'signup'))
"""
# The newest sample at each 30 s instant, at most 300 s old, over the whole time span.
ON_GRID = """
span as (select min(ts_us) // 30000000 as lo, (max(ts_us) + 300000000) // 30000000 as hi from samples),
series as (select distinct metric, job, cluster, instance, area from samples),
grid as (
  select s.*, g."at", g."at" * 30000000 as at_us
  from series s, (select unnest(generate_series(lo, hi)) as "at" from span) g),
on_grid as (
  select g.metric, g.job, g.cluster, g.instance, g.area, g."at", s.value
  from grid g asof join samples s
    on g.metric = s.metric and g.job = s.job and g.cluster = s.cluster
   and g.instance = s.instance and g.area = s.area and g.at_us >= s.ts_us
  where g.at_us - s.ts_us <= 300000000)
"""
