"""Queries over topic messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import topics
from ..session import written
from . import requests, views
from .views import with_cte


def offset_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.offset_summary(views.messages(spark, sf_dir))


def next_recommendation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first recommendation after all of partition 0 and half of partition 1 was read."""
    found = requests.recommend_requests(spark, sf_dir).select(
        F.lit("recommendations").alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.expr("event_id div 3").alias("offset"),
        F.to_json(F.struct("product_id", "product_name"), {"ignoreNullFields": "false"}).alias("value"),
    )
    places = views.table(spark, sf_dir, "events").select(
        (F.col("event_id") % 3).cast("int").alias("partition"), F.expr("event_id div 3").alias("offset")
    )
    last = places.filter("partition < 2").groupBy("partition").agg(F.max("offset").alias("last"))
    committed = last.select(
        F.lit("recommendations").alias("topic"),
        "partition",
        F.expr("case partition when 0 then last + 1 else last div 2 end").alias("next_offset"),
    )
    return topics.next_message(found, "recommendations", written(committed, "committed"))


def replica_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replica that lost, changed and repeated messages."""
    source = views.messages(spark, sf_dir)
    changed = F.when(F.col("offset") % 101 == 0, F.lit("{}")).otherwise(F.col("value"))
    copies = F.when(F.col("offset") % 103 == 0, F.lit(2)).otherwise(F.lit(1))
    replica = (
        source.filter("offset % 97 <> 0")
        .withColumn("value", changed)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    )
    return topics.reconcile(source, replica, ["topic", "partition", "offset", "value"])


QUERIES = {
    "offset_summary": (
        offset_summary,
        with_cte(
            views.MESSAGES,
            body="""
select topic, "partition", min("offset") as first_offset, max("offset") as last_offset,
       max("offset") + 1 as next_offset, count(*) as message_count
from messages group by topic, "partition"
""",
        ),
    ),
    "next_recommendation": (
        next_recommendation,
        f"""
with found as ({requests.QUERIES["recommend"][1]}),
placed as (
  select cast(event_id % 3 as integer) as "partition", event_id // 3 as "offset",
         '{{"product_id":"' || product_id || '","product_name":"' || product_name || '"}}' as value
  from found),
committed as (
  select "partition", case "partition" when 0 then max("offset") + 1 else max("offset") // 2 end as next_offset
  from placed where "partition" < 2 group by "partition")
select 'recommendations' as topic, p."partition", p."offset", p.value
from placed p left join committed c on c."partition" = p."partition"
where c.next_offset is null or p."offset" >= c.next_offset
order by p."partition", p."offset" limit 1
""",
    ),
    "replica_reconcile": (
        replica_reconcile,
        with_cte(
            views.MESSAGES,
            """
replica as (
  select topic, "partition", "offset",
         case when "offset" % 101 = 0 then '{}' else value end as value
  from messages where "offset" % 97 <> 0),
doubled as (select * from replica union all select * from replica where "offset" % 103 = 0),
lost as (select * from messages except all select * from doubled),
gained as (select * from doubled except all select * from messages)
""",
            body="""
select topic, "partition", "offset", value, cast(sum(l) as bigint) as missing, cast(sum(g) as bigint) as extra
from (select *, 1 as l, 0 as g from lost union all select *, 0, 1 from gained)
group by topic, "partition", "offset", value
""",
        ),
    ),
}
