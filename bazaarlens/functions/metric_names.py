"""Rename rules that turn managed-bean attributes into metric names, types and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .jsontext import first_case

# Exporter rules in order (pattern, name, type, labels); the first match wins.
RENAME_RULES = [
    (r"kafka.server<type=(.+), name=(.+)PerSec\w*><>Count", "kafka_server_$1_$2_total", "COUNTER", {}),
    (r"kafka.server<type=(.+), name=(.+)PerSec\w*><>OneMinuteRate", "kafka_server_$1_$2_rate", "GAUGE", {}),
    (r"kafka.server<type=(.+), name=(.+)Percent\w*><>Mean", "kafka_server_$1_$2_mean", "GAUGE", {}),
    (
        r"kafka.server<type=(.+), name=(.+)Percent\w*><>50thPercentile",
        "kafka_server_$1_$2_50th_percentile",
        "GAUGE",
        {},
    ),
    (
        r"kafka.server<type=(.+), name=(.+)Percent\w*><>99thPercentile",
        "kafka_server_$1_$2_99th_percentile",
        "GAUGE",
        {},
    ),
    (r"kafka.server<type=ReplicaManager, name=(.+)><>Value", "kafka_replica_manager_$1", "GAUGE", {}),
    (
        r"kafka.server<type=KafkaRequestHandlerPool, name=(.+)><>Value",
        "kafka_request_handler_$1",
        "GAUGE",
        {},
    ),
    (r"kafka.network<type=(.+), name=(.+)><>Value", "kafka_network_$1_$2", "GAUGE", {}),
    (
        r"kafka.log<type=Log, name=(.+), topic=(.+), partition=(.+)><>Value",
        "kafka_log_$1",
        "GAUGE",
        {"topic": "$2", "partition": "$3"},
    ),
    (r"kafka.controller<type=(.+), name=(.+)><>Value", "kafka_controller_$1_$2", "GAUGE", {}),
    (r"java.lang<type=Memory><>HeapMemoryUsage", "jvm_memory_heap_bytes", "UNTYPED", {"area": "heap"}),
    (r"java.lang<type=Memory><>NonHeapMemoryUsage", "jvm_memory_nonheap_bytes", "UNTYPED", {"area": "nonheap"}),
    (
        r"java.lang<type=GarbageCollector, name=(.+)><>CollectionTime",
        "jvm_gc_collection_time_seconds",
        "UNTYPED",
        {"gc": "$1"},
    ),
    (
        r"java.lang<type=GarbageCollector, name=(.+)><>CollectionCount",
        "jvm_gc_collection_count",
        "UNTYPED",
        {"gc": "$1"},
    ),
]
# The bean domains that are exported at all.
EXPORTED_DOMAINS = ["kafka.controller", "kafka.server", "kafka.network", "kafka.log"]

LABEL_SEPARATOR = "\x1f"


def rename(beans: DataFrame, bean: str = "bean", domains: list[str] | None = None) -> DataFrame:
    """Beans that a rule exports, with ``rule``, ``name``, ``type`` and ``labels`` of the first match.

    ``domains`` limits the export; an empty list exports every domain.
    """
    domains = EXPORTED_DOMAINS if domains is None else domains
    rows = beans.filter(F.substring_index(bean, "<", 1).isin(domains)) if domains else beans

    def matches(pattern: str) -> Column:
        # All patterns end in the literal attribute; most beans fail on it without any regex.
        tail = pattern[pattern.rindex("><>") :]
        return F.contains(F.col(bean), F.lit(tail)) & F.col(bean).rlike(pattern)

    number = first_case([(matches(rule[0]), F.lit(i)) for i, rule in enumerate(RENAME_RULES)])
    # No rule, no row. A filter would be moved below the column and test all patterns twice.
    rows = rows.withColumn("rule", F.explode(F.array_compact(F.array(number))))

    def by_rule(texts: list[str]) -> Column:
        return F.get(F.array(*map(F.lit, texts)), F.col("rule"))

    def filled(templates: list[str]) -> Column:
        """The template of the row's rule with the groups of its pattern put in."""
        with_groups = [
            (F.col("rule") == i, F.regexp_replace(bean, f"^.*?{RENAME_RULES[i][0]}.*$", template))
            for i, template in enumerate(templates)
            if "$" in template
        ]
        return F.coalesce(first_case(with_groups), by_rule(templates))

    labels = [LABEL_SEPARATOR.join(f"{k}={v}" for k, v in rule[3].items()) for rule in RENAME_RULES]
    label_map = F.str_to_map(filled(labels), F.lit(LABEL_SEPARATOR), F.lit("="))
    legal = F.regexp_replace(filled([rule[1] for rule in RENAME_RULES]), "[^a-zA-Z0-9:_]|_+", "_")
    return (
        rows.withColumn("name", F.lower(F.regexp_replace(legal, "_+", "_")))
        .withColumn("type", by_rule([rule[2] for rule in RENAME_RULES]))
        .withColumn("labels", F.map_filter(label_map, lambda key, _: key != ""))
        .withColumn("rule", F.col("rule") + 1)
    )
