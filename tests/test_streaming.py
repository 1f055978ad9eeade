import json
import random

import pytest
from pyspark.sql import functions as F

from bazaarlens import schemas
from bazaarlens.functions.filtered_line import parse_line
from bazaarlens.operators import alerts, metrics, popularity, recommend, requests
from bazaarlens.operators.alerts import Rule
from bazaarlens.session import is_small, shared_dir, written
from bazaarlens.sinks.files import write_popular
from bazaarlens.sources import files
from bazaarlens.sources.topics import stream_files
from bazaarlens.streaming import alert_watch, jobs

VALUE = "value string"


def feed(spark, folder, values, schema=VALUE):
    """One file of a file topic."""
    rows = [v if isinstance(v, tuple) else (v,) for v in values]
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def source(spark, folder, schema=VALUE):
    from pyspark.sql.types import StructType

    return stream_files(spark, folder, StructType.fromDDL(schema), per_trigger=1)


def test_filter_rereads_the_list_and_survives_restarts(spark, tmp_path):
    topic, out, check, listed = (str(tmp_path / n) for n in ("topic", "out", "check", "allow.json"))

    def step():
        load = lambda session: files.read_allow_list(session, listed)
        jobs.filter_products(source(spark, topic), load, out, check, once=True).awaitTermination()
        return sorted(r["product_id"] for r in files.read_filtered_products(spark, out).collect())

    def product(pid):
        return json.dumps({"product_id": pid, "name": f"n{pid}", "price": {"amount": 1.5, "currency": "RUB"}})

    feed(spark, topic, [product("1"), product("2"), None, "not json"])
    assert step() == [""]  # no list: only the unreadable record passes
    (tmp_path / "allow.json").write_text('{"allowed_product_ids": ["1"]}')
    feed(spark, topic, [product("1"), product("2")])
    assert step() == ["", "1"]
    (tmp_path / "allow.json").write_text('{"allowed_product_ids": ["1", "2"]}')
    feed(spark, topic, [product("2")])
    feed(spark, topic, [product("1")])
    assert step() == ["", "1", "1", "2"]
    assert step() == ["", "1", "1", "2"]
    row = files.read_lines(spark, out).filter("value like '%id=2%'").select(*parse_line(F.col("value"))).first()
    assert (row["name"], row["price"]["amount"], row["price"]["currency"]) == ("n2", 1.5, "RUB")


def payloads(spark, terms):
    rows = spark.createDataFrame([(t,) for t in terms], "product_name string").withColumn(
        "ts", F.lit("2024-01-01 00:00:05").cast("timestamp")
    )
    return [r["value"] for r in requests.request_envelope(rows).collect()]


def test_recommendations_equal_the_batch_ones(spark, tmp_path):
    topic, out, bad, check, base = (str(tmp_path / n) for n in ("topic", "out", "bad", "check", "base"))
    terms = ["Ring", "hot ring plate", None, "", "zzz"] * 3

    def step():
        jobs.recommend_requests(source(spark, topic), base, out, bad, check, once=True, at="timestamp").awaitTermination()
        rows = jobs.read_batches(spark, out, schemas.MESSAGE_TEXT)
        return sorted(json.loads(r["value"])["product_name"] for r in rows.collect())

    feed(spark, topic, payloads(spark, ["early"]) + ["garbage"])
    assert step() == ["early - Recommended"]
    popular = spark.createDataFrame([(1, "Ring", 3), (2, "plate", 2)], schemas.POPULAR)
    write_popular(popular, base)
    feed(spark, topic, payloads(spark, terms[:7]))
    feed(spark, topic, payloads(spark, terms[7:]) + ['{"product_name":5}'])
    batch = spark.createDataFrame([(t, "t") for t in terms], "product_name string, timestamp string")
    expected = [r["product_name"] for r in recommend.recommend(batch, popular).collect()]
    assert step() == sorted(expected + ["early - Recommended"])
    quarantined = jobs.read_batches(spark, bad, schemas.MESSAGE_TEXT)
    assert sorted(r["value"] for r in quarantined.collect()) == ["garbage", '{"product_name":5}']


def test_replayed_batches_replace_their_output(spark, tmp_path):
    topic, out, bad, check = (str(tmp_path / n) for n in ("topic", "out", "bad", "check"))
    feed(spark, topic, payloads(spark, ["a"]))
    feed(spark, topic, payloads(spark, ["b"]))
    for _ in range(2):
        jobs.recommend_requests(source(spark, topic), str(tmp_path), out, bad, check, once=True).awaitTermination()
        # Forget the last commit, as if the job had died before it.
        commits = sorted((tmp_path / "check" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
        commits[-1].unlink()
        for crc in (tmp_path / "check" / "commits").glob(f".{commits[-1].name}.crc"):
            crc.unlink()
    rows = jobs.read_batches(spark, out, schemas.MESSAGE_TEXT).collect()
    assert sorted(json.loads(r["value"])["product_name"] for r in rows) == ["a - Recommended", "b - Recommended"]


def test_popularity_follows_the_stream(spark, tmp_path):
    topic, check, base = (str(tmp_path / n) for n in ("topic", "check", "base"))
    schema = "product_name string"

    def step():
        jobs.refresh_popular(source(spark, topic, schema), base, check, 2, once=True).awaitTermination()
        return [tuple(r) for r in files.read_popular(spark, base).orderBy("rank").collect()]

    feed(spark, topic, ["a", "b", "b", None], schema)
    assert step() == [(1, "b", 2), (2, "a", 1)]
    feed(spark, topic, ["a", "a", "c"], schema)
    assert step() == [(1, "a", 3), (2, "b", 2)]
    batch = spark.read.schema(schema).parquet(topic)
    assert [tuple(r) for r in popularity.popular_products(batch, 2).collect()] == step()


def test_archive_and_replica(spark, tmp_path):
    topic = str(tmp_path / "topic")
    feed(spark, topic, payloads(spark, ["a", None]) + ["garbage"])
    jobs.archive_requests(source(spark, topic), str(tmp_path / "requests"), str(tmp_path / "c1"), once=True).awaitTermination()
    assert sorted(r["product_name"] for r in files.read_requests(spark, str(tmp_path)).collect()) == ["", "a"]
    assert (tmp_path / "requests" / "dt=2024-01-01").is_dir()
    schema = "topic string, partition int, offset long, value string"
    feed(spark, str(tmp_path / "m"), [("t", 0, 1, "a"), ("u", 1, 1, None)], schema)
    jobs.replicate(source(spark, str(tmp_path / "m"), schema), str(tmp_path / "r"), str(tmp_path / "c2"), once=True).awaitTermination()
    copied = spark.read.schema("value string, partition int, offset long, topic string").parquet(str(tmp_path / "r"))
    assert sorted(map(tuple, copied.select("topic", "partition", "offset", "value").collect())) == [("t", 0, 1, "a"), ("u", 1, 1, None)]


RULES = [
    Rule("Low", "m", "<", 3, 60, "warning"),
    Rule("Zero", "m", "==", 0, 0, "critical"),
    Rule("Share", "m", ">", 0.5, 60, "info", per="max"),
    Rule("Slow", "n", "<", 0.05, 90, "info", window=300),
]
LABELS = ["instance"]
SCHEMA = "metric string, instance string, ts_us long, value double"


@pytest.mark.parametrize("seed,files_count", [(1, 6), (2, 3)])
def test_alert_events_equal_the_batch_ones(spark, tmp_path, seed, files_count):
    rng = random.Random(seed)
    start = 1_704_067_200 * metrics.SECOND
    rows, count = [], 0
    for t in range(0, 3600, 20):
        count += rng.randrange(4)
        for instance in ("a", "b"):
            if rng.random() < (0.7 if 900 < t < 1500 else 0.97) and not (instance == "b" and 2000 < t < 2500):
                at = start + t * metrics.SECOND + rng.randrange(metrics.SECOND)
                rows.append(("m", instance, at, float(rng.choice([0, 1, 2, 2, 2, 9]) if t % 400 < 300 else 9)))
                rows.append(("max", instance, at, 10.0))
                rows.append(("n", instance, at, float(count if instance == "a" else count % 40)))
    rows.sort(key=lambda r: r[2])
    cuts = sorted(rng.sample(range(1, len(rows)), files_count - 1))
    topic, out, check = (str(tmp_path / n) for n in ("topic", "out", "check"))

    def step():
        alert_watch.watch(source(spark, topic, SCHEMA), RULES, out, check, LABELS, once=True).awaitTermination()

    for i, (low, high) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
        feed(spark, topic, rows[low:high], SCHEMA)
        if i % 2 or i == files_count - 1:
            step()
    keys = [*alerts.ALERT, *LABELS]
    streamed = jobs.read_batches(spark, out, alert_watch.event_schema(LABELS)).select(*keys, "state", "at")
    until = rows[-1][2] // (30 * metrics.SECOND)
    spans = alerts.evaluate(spark.createDataFrame(rows, SCHEMA), RULES, LABELS)
    spans = spans.withColumn("to_at", F.least("to_at", F.lit(until))).filter("from_at <= to_at")
    batch = alert_watch.run_events(alerts.alert_runs(spans, LABELS), keys, -1, until)
    got, expected = sorted(map(tuple, streamed.collect())), sorted(map(tuple, batch.select(*keys, "state", "at").collect()))
    assert got == expected
    assert {r[-2] for r in got} == {"pending", "firing", "resolved", "inactive"}
    assert {r[0] for r in got} == {"Low", "Zero", "Share", "Slow"}


def test_shared_folder_and_size_check(spark, tmp_path):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_dir(spark, "x") != shared_dir(spark, "x")
    rows = spark.range(10).selectExpr("cast(id as string) as s")
    assert is_small(rows, 10) and not is_small(rows, 9)
    assert not is_small(rows.selectExpr("repeat('x', 1000) as s"), 100, 5000)
    copy = written(rows, "rows")
    assert copy.count() == 10 and "parquet" in copy._jdf.queryExecution().executedPlan().toString().lower()


def test_late_samples_count_as_if_in_order(spark, tmp_path):
    """Files whose times overlap give the changes of the same samples in order, up to the lateness."""
    rng = random.Random(4)
    rule = Rule("Down", "up", "==", 0, 60, "critical")
    rows = []
    for instance in "abc":
        value = 1.0
        for t in range(0, 3600, 15):
            value = rng.choice([value] * 9 + [0.0, 1.0])
            rows.append(("up", "job", "cluster", instance, "", t * 1_000_000, value))
    schema = "metric string, job string, cluster string, instance string, area string, ts_us long, value double"
    folder, late = str(tmp_path / "in"), 600
    order = sorted(rows, key=lambda r: r[5] + rng.randrange(late * 900_000))
    for k in range(6):
        part = order[k * len(order) // 6 : (k + 1) * len(order) // 6]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
    stream = stream_files(spark, folder, spark.createDataFrame(rows, schema).schema, per_trigger=1)
    work = str(tmp_path)
    alert_watch.watch(stream, [rule], f"{work}/out", f"{work}/c", once=True, lateness=late).awaitTermination()
    found = jobs.read_batches(spark, f"{work}/out", alert_watch.event_schema())
    until = (max(r[5] for r in rows) - late * 1_000_000) // 30_000_000
    runs = alerts.alert_runs(alerts.evaluate(spark.createDataFrame(rows, schema), [rule]))
    keys = [*alerts.ALERT, *alerts.LABELS]
    want = alert_watch.run_events(runs, keys, -1, 10**9).filter(f"at <= {until}")
    names = ["instance", "state", "at"]
    assert found.select(*names).exceptAll(want.select(*names)).count() == 0
    assert want.select(*names).exceptAll(found.select(*names)).count() == 0
    assert found.filter("state = 'firing'").count() > 0


def test_a_list_is_read_whole_while_it_is_replaced(spark, tmp_path):
    base = str(tmp_path)
    popular = spark.createDataFrame([(1, "a", 5)], "rank int, product_name string, search_count long")
    write_popular(popular, base)
    half = tmp_path / "recommendations" / "v=99999999999999999999-half"
    half.mkdir()
    (half / "part-00000.json").write_text('{"rank":1,"product_name":"half","search_count":1}\n')
    assert [r["product_name"] for r in files.read_popular(spark, base).collect()] == ["a"]
    begun = files.read_popular(spark, base)
    write_popular(popular.selectExpr("rank", "'b' as product_name", "search_count"), base)
    assert [r["product_name"] for r in begun.collect()] == ["a"]
    assert [r["product_name"] for r in files.read_popular(spark, base).collect()] == ["b"]
    for name in "cd":
        write_popular(popular.selectExpr("rank", f"'{name}' as product_name", "search_count"), base)
    complete = [p.name for p in (tmp_path / "recommendations").glob("v=*") if (p / "_SUCCESS").exists()]
    assert len(complete) == 2


def test_a_message_is_decoded_once_for_both_sinks(spark, tmp_path):
    """The sinks read what was decoded: its fields are cached, not the messages."""
    cached, write = [], lambda found, batch_id: cached.append(found._jdf.queryExecution().withCachedData().toString())
    topic, bad, check = (str(tmp_path / n) for n in ("topic", "bad", "check"))
    feed(spark, topic, payloads(spark, ["a"]) + ["garbage"])
    jobs.recommend_requests(source(spark, topic), str(tmp_path), "", bad, check, once=True, write=write).awaitTermination()
    (plan,) = cached
    relation = plan[plan.index("InMemoryRelation") :]
    assert "_request" in relation.split("]")[0]
    assert [r["value"] for r in spark.read.parquet(bad).collect()] == ["garbage"]
