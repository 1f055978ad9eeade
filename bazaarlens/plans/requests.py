"""Queries over search requests: popularity, recommendation, envelopes, archive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import archive_name, rfc3339
from ..operators import popularity, recommend, requests
from ..session import shared_dir, written
from ..sinks import compacted
from ..sinks.topics import as_messages
from . import views
from .views import with_cte


def term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return popularity.term_counts(views.searches(spark, sf_dir))


def popular_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return popularity.popular_products(views.searches(spark, sf_dir))


def _recommended(spark: SparkSession, sf_dir: str, n: int, inline: bool) -> DataFrame:
    searches = views.searches(spark, sf_dir)
    stamped = searches.withColumn("timestamp", rfc3339(F.col("ts")))
    popular = popularity.popular_products(searches, n)
    found = recommend.recommend(stamped, popular, term="term", keep=["event_id"], inline=inline)
    return found.withColumn("alternatives", F.array_join("alternatives", "|"))


def recommend_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The list has at most ten rows by construction, so it need not be measured.
    return _recommended(spark, sf_dir, popularity.TOP_N, inline=True)


def recommend_alternatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend_requests(spark, sf_dir).select("event_id", "alternatives")


def recommend_long_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each ordered item was searched for as its name and order: all these terms count as popular.

    The list has most of the order lines' rows. It is stored once, and joined, not inlined.
    """
    ordered = views.ordered_terms(spark, sf_dir)
    popular = written(popularity.popular_products(ordered, None), "popular")
    searches = views.searches(spark, sf_dir).withColumn("timestamp", rfc3339(F.col("ts")))
    exact = searches.withColumn("term", F.concat("product_name", F.lit(" "), F.col("event_id").cast("string"), F.lit("x")))
    found = recommend.recommend(exact, popular, term="term", keep=["event_id"], inline=False)
    return found.withColumn("alternatives", F.array_join("alternatives", "|"))


BEST = """
best as (
  select s.event_id, arg_min(p.product_name, p.rank) as matched
  from searches s join popular p
    on contains(lower(coalesce(s.term, '')), lower(p.product_name))
  group by s.event_id)
"""
# A term ends with the event's number: a name and order is in it if it is a beginning of a rest of the term.
LONG_LISTED = (
    """
ordered as (
  select p.p_name || ' ' || l.l_orderkey as product_name from lineitem l join part p on p.p_partkey = l.l_partkey),
popular as (
  select row_number() over (order by count(*) desc, product_name) as rank, product_name, count(*) as search_count
  from ordered group by product_name)
""",
    """
rests as (
  select event_id, substring(lower(coalesce(term, '')), unnest(generate_series(1, length(coalesce(term, ''))))) as rest
  from searches),
best as (
  select event_id, arg_min(p.product_name, p.rank) as matched
  from (select event_id, substring(rest, 1, unnest(generate_series(1, length(rest)))) as piece from rests) r
  join popular p on lower(p.product_name) = r.piece
  group by event_id)
""",
)
LONG_SEARCHES = views.SEARCHES.replace(
    "p.p_name else p.p_name || ' ' || lower(p.p_type) end", "p.p_name || ' ' || e.event_id || 'x' else p.p_name || ' ' || e.event_id || 'x' end"
)


def _recommend_sql(*listed: str, searches: str = views.SEARCHES) -> str:
    return with_cte(
        searches,
        *listed,
        """
chosen as (
  select s.event_id, s.ts, coalesce(s.term, '') as term,
         coalesce(b.matched || ' - Popular',
                  (select product_name from popular where rank = 1) || ' - Trending',
                  coalesce(s.term, '') || ' - Recommended') as product_name
  from searches s left join best b using (event_id)),
alternatives as (
  select c.event_id, string_agg(p.product_name, '|' order by p.rank) as alternatives
  from chosen c join popular p on p.rank <= 3 and p.product_name <> c.term group by c.event_id)
""",
        body="""
select c.event_id, 'rec_' || c.product_name as product_id, c.product_name,
       'Popular recommendation' as reason, cast(0.9 as double) as confidence,
       coalesce(a.alternatives, 'alt_1|alt_2|alt_3') as alternatives,
       strftime(c.ts, '%Y-%m-%dT%H:%M:%SZ') as "timestamp"
from chosen c left join alternatives a using (event_id)
""",
    )


SHORT_LIST_SQL = _recommend_sql(views.RANKED, views.POPULAR, BEST)


def recommendation_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recommendations as topic messages."""
    searches = views.searches(spark, sf_dir).withColumn("timestamp", rfc3339(F.col("ts")))
    popular = popularity.popular_products(searches)
    return as_messages(recommend.recommend(searches, popular, term="term", inline=True), "recommendations")


def request_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.request_envelope(views.searches(spark, sf_dir)).select("event_id", "value")


REQUEST_JSON = """
texts as (
  select event_id, '{"product_name":' || coalesce('"' || product_name || '"', 'null')
         || ',"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || '"}' as body
  from searches)
"""


def request_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as they may arrive: enveloped, plain, and six ways of being damaged."""
    searches = views.searches(spark, sf_dir)
    body = requests.request_json(F.col("product_name"), F.col("ts"))
    sealed = requests.request_envelope(searches.withColumn("body", body)).withColumnRenamed("value", "sealed")
    kind = F.col("event_id") % 10
    value = (
        F.when(kind == 0, F.col("body"))
        .when(kind == 1, F.concat(F.lit('"'), F.substring("body", 3, 12), F.lit('!"')))
        .when(kind == 2, F.concat(F.rtrim(F.regexp_replace("sealed", '="?|"$', "")), F.lit('x"')))
        .when(kind == 3, F.lit('{"product_name":5}'))
        .when(kind == 4, F.concat(F.col("body"), F.lit(" tail")))
        .when(kind == 5, F.lit('{"timestamp":"t","other":[1]}'))
        .when(kind == 6, F.lit("garbage"))
        .otherwise(F.col("sealed"))
    )
    return sealed.select("event_id", value.alias("value"))


def request_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = requests.decode_requests(request_payloads(spark, sf_dir))
    return rows.select("event_id", "decoded", "product_name", "timestamp")


def _archive_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes of three users' worth of records per second, so that names collide."""
    at = F.timestamp_micros(F.lit(views.BASE_US) + F.col("event_id") % 20 * 1_000_000 + F.col("event_id"))
    return views.table(spark, sf_dir, "events").select("event_id", "user_id", at.alias("ts"), "props")


def archive_last_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _archive_records(spark, sf_dir)
    kept = requests.last_write(rows, "user_id", "ts", ["event_id"], ["props"])
    return kept.select("file_name", "user_id", "writes", "props")


def archive_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from an archive that takes the records in four parts, each compacted into it."""
    path, keys = shared_dir(spark, "archive"), ["user_id", "second"]
    records = _archive_records(spark, sf_dir).withColumn("second", F.date_trunc("second", "ts"))
    for number in range(4):
        part = records.filter(F.pmod(F.xxhash64("event_id"), F.lit(4)) == number)
        compacted.add(part, path, keys, ["ts", "event_id"])
    name = archive_name(F.col("user_id").cast("string"), F.col("second")).alias("file_name")
    return compacted.read(spark, path, keys).select(name, "user_id", "writes", "props")


QUERIES = {
    "term_counts": (
        term_counts,
        with_cte(
            views.SEARCHES,
            body="""
select product_name as search_term, count(*) as search_count
from searches where product_name is not null group by product_name
""",
        ),
    ),
    "popular_products": (
        popular_products,
        with_cte(
            views.SEARCHES,
            views.RANKED,
            views.POPULAR,
            body="select cast(rank as integer) as rank, product_name, search_count from popular",
        ),
    ),
    "recommend": (recommend_requests, SHORT_LIST_SQL),
    "recommend_alternatives": (
        recommend_alternatives,
        f"select event_id, alternatives from ({SHORT_LIST_SQL}) r",
    ),
    "recommendation_messages": (
        recommendation_messages,
        f"""
select 'recommendations' as topic,
       '{{"product_id":"' || product_id || '","product_name":"' || product_name || '","reason":"' || reason
       || '","confidence":0.9,"alternatives":["' || replace(alternatives, '|', '","') || '"],"timestamp":"'
       || "timestamp" || '"}}' as value
from ({SHORT_LIST_SQL}) r
""",
    ),
    "recommend_long_list": (recommend_long_list, _recommend_sql(*LONG_LISTED, searches=LONG_SEARCHES)),
    "request_envelope": (
        request_envelope,
        with_cte(
            views.SEARCHES,
            REQUEST_JSON,
            body="""select event_id, '"' || to_base64(encode(body)) || '"' as value from texts""",
        ),
    ),
    "request_decode": (
        request_decode,
        with_cte(
            views.SEARCHES,
            REQUEST_JSON,
            body="""
select event_id,
       event_id % 10 in (0, 5, 7, 8, 9) as decoded,
       case when event_id % 10 in (0, 7, 8, 9) then coalesce(body::json->>'$.product_name', '')
            when event_id % 10 = 5 then '' end as product_name,
       case when event_id % 10 in (0, 7, 8, 9) then body::json->>'$.timestamp'
            when event_id % 10 = 5 then 't' end as "timestamp"
from texts
""",
        ),
    ),
    "archive_last_write": (
        archive_last_write,
        with_cte(
            f"""
records as (
  select event_id, user_id, props,
         make_timestamp({views.BASE_US} + event_id % 20 * 1000000 + event_id) as ts
  from events),
numbered as (
  select *, count(*) over (partition by user_id, date_trunc('second', ts)) as writes,
         row_number() over (partition by user_id, date_trunc('second', ts)
                            order by ts desc, event_id desc) as rn
  from records)
""",
            body="""
select cast(user_id as varchar) || '_' || strftime(ts, '%Y%m%d_%H%M%S') || '_000.json' as file_name,
       user_id, writes, props
from numbered where rn = 1
""",
        ),
    ),
}
QUERIES["archive_compacted"] = (archive_compacted, QUERIES["archive_last_write"][1])
