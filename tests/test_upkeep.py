"""Kept search counts, the compacted archive, stored versions, and rates of a stream."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from bazaarlens import schemas
from bazaarlens.operators import alerts, metrics, popularity
from bazaarlens.sinks import compacted, versions
from bazaarlens.sources.files import read_popular, read_requests
from bazaarlens.sources.topics import stream_files, stream_log
from bazaarlens.sinks.topics import write_log
from bazaarlens.streaming import jobs, rates, search_counts

KEYS, ORDER = ["record", "second"], ["at"]


def add_requests(spark, base, rows):
    frame = spark.createDataFrame(rows, "product_name string, timestamp string").coalesce(1)
    frame.write.mode("append").json(f"{base}/requests")


def refresh(spark, base):
    stream = stream_files(spark, f"{base}/requests", schemas.REQUEST, "json")
    search_counts.refresh(spark, stream, base, f"{base}/checkpoint", n=3)


def listed(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_kept_counts_equal_counting_anew_after_every_refresh(spark, tmp_path):
    base = str(tmp_path / "store")
    days = [
        [("tea", "2024-01-02T10:00:00Z"), ("tea", "2024-01-02T11:00:00Z"), ("", "2024-01-02T11:00:00Z"), (None, "2024-01-02T11:00:00Z")],
        [("cup", "2024-01-03T10:00:00Z")] * 3 + [("tea", "2024-01-01T10:00:00Z"), ("cup", "soon"), ("cup", None)],  # late, and no dates
        [("pot", "2024-01-02T10:00:00Z")] * 4 + [("tea", "2024-01-02T23:59:59Z")],
        [(None, None)],
    ]
    every = []
    for number, rows in enumerate(days):
        add_requests(spark, base, rows)
        refresh(spark, base)
        if number != 1:
            search_counts.fold(spark, base)
        every += [(t, d[:10] if d and d[0] == "2" else None) for t, d in rows if t is not None]
        assert listed(search_counts.totals(spark, base)) == listed(popularity.term_counts(read_requests(spark, base)))
        assert listed(read_popular(spark, base)) == listed(popularity.popular_products(read_requests(spark, base), 3))
        found = {(r["search_term"], r["day"] and str(r["day"])): r["search_count"] for r in search_counts.daily(spark, base).collect()}
        assert found == Counter(every)
    since = search_counts.totals(spark, base, since="2024-01-02")
    assert dict(map(tuple, since.collect())) == {"tea": 3, "": 1, "cup": 3, "pot": 4}


def test_a_refresh_reads_new_requests_only(spark, tmp_path):
    base = str(tmp_path / "store")
    add_requests(spark, base, [("tea", "2024-01-02T10:00:00Z")] * 50)
    refresh(spark, base)
    search_counts.fold(spark, base)
    add_requests(spark, base, [("cup", "2024-01-02T10:00:00Z")])
    query = search_counts.count_new(stream_files(spark, f"{base}/requests", schemas.REQUEST, "json"), base, f"{base}/checkpoint")
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1
    assert dict(map(tuple, search_counts.totals(spark, base).collect())) == {"tea": 50, "cup": 1}


def test_replayed_and_half_written_batches_count_once(spark, tmp_path):
    base = str(tmp_path / "store")
    add_requests(spark, base, [("tea", "2024-01-02T10:00:00Z")] * 2)
    refresh(spark, base)
    search_counts.fold(spark, base)
    folder = search_counts._batches(base)
    rows = spark.createDataFrame([(None, "tea", 2)], search_counts.COUNTS)
    rows.write.mode("overwrite").parquet(f"{folder}/batch_id=0")  # handled again after it was merged
    rows.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{folder}/batch_id=1")
    assert dict(map(tuple, search_counts.totals(spark, base).collect())) == {"tea": 2}
    search_counts.fold(spark, base)
    add_requests(spark, base, [("tea", "2024-01-02T10:00:00Z")])
    refresh(spark, base)  # the half-written batch is replaced
    assert dict(map(tuple, search_counts.totals(spark, base).collect())) == {"tea": 3}


def test_an_empty_store(spark, tmp_path):
    base = str(tmp_path / "store")
    assert search_counts.totals(spark, base).count() == 0
    search_counts.fold(spark, base)
    search_counts.fold(spark, base)
    assert search_counts.daily(spark, base).count() == 0


def test_versions_are_numbered_and_old_ones_go_by_count_or_age(spark, tmp_path):
    path = str(tmp_path / "list")
    for number in range(4):
        versions.write(spark.range(number, number + 1), path, "parquet")
        assert spark.read.parquet(versions.current(spark, path)).first()[0] == number
    assert [spark.read.parquet(p).first()[0] for p in versions.complete(spark, path)] == [2, 3]
    versions.tidy(spark, path, kept=1, hours=1)
    assert len(versions.complete(spark, path)) == 2  # nobody loses a version it has begun to read
    versions.tidy(spark, path, kept=1)
    assert [spark.read.parquet(p).first()[0] for p in versions.complete(spark, path)] == [3]


def records(spark, rows):
    return spark.createDataFrame(rows, "record string, second int, at int, body string")


def last_writes(rows):
    kept, writes = {}, Counter()
    for record, second, at, body in rows:
        writes[record, second] += 1
        kept[record, second] = max(kept.get((record, second), (at, body)), (at, body))
    return sorted((*key, *value, writes[key]) for key, value in kept.items())


@pytest.mark.parametrize("bucket_rows", [7, 10_000])
def test_archive_keeps_the_last_write(spark, tmp_path, bucket_rows):
    path, choose, every = str(tmp_path / "archive"), random.Random(3), []
    for _ in range(4):
        # A third of the rows are of one record.
        part = [("hot" if choose.random() < 0.33 else f"r{choose.randrange(40)}", choose.randrange(9), len(every) + i, f"b{i}") for i in range(60)]
        part += part[:5]
        every += part
        compacted.add(records(spark, part), path, KEYS, ORDER, bucket_rows)
    found = compacted.read(spark, path, KEYS).select(*KEYS, "at", "body", "writes")
    assert listed(found) == [tuple(r) for r in last_writes(every)]


def test_earlier_writes_that_come_late_do_not_win(spark, tmp_path):
    path = str(tmp_path / "archive")
    compacted.add(records(spark, [("a", 1, 5, "new")]), path, KEYS, ORDER)
    compacted.add(records(spark, [("a", 1, 4, "old"), ("b", 1, 1, None)]), path, KEYS, ORDER)
    compacted.add(records(spark, []), path, KEYS, ORDER)
    found = compacted.read(spark, path, KEYS).select(*KEYS, "at", "body", "writes")
    assert listed(found) == [("a", 1, 5, "new", 2), ("b", 1, 1, None, 1)]
    assert compacted.read(spark, str(tmp_path / "none"), KEYS) is None


def test_compacted_archives_merge_without_a_shuffle(spark, tmp_path, plan_of):
    paths = [str(tmp_path / name) for name in "ab"]
    for number, path in enumerate(paths):
        rows = [(f"r{i}", 0, number, "x") for i in range(number, 40)]
        compacted.add(records(spark, rows), path, KEYS, ORDER, bucket_rows=8)
    old, new = [compacted.read(spark, path, KEYS) for path in paths]
    hint = new.hint("merge")
    both = compacted.merged(old, hint, KEYS, ORDER)
    plan = plan_of(both)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert both.count() == 40
    assert len({r[0] for r in old.select(F.input_file_name()).distinct().collect()}) == 5  # one file per bucket


SERIES = ["metric", "job"]


def counter_rows():
    choose, rows = random.Random(5), []
    for job in ("a", "b"):
        value = 0.0
        for i in range(160):
            value = 3.0 if choose.random() < 0.1 else value + choose.randrange(1, 50)
            rows.append(("m", job, 1_000_000_000_000_000 + i * 11_000_000 + (job == "b"), value))
    rows.append(("m", "a", rows[3][2], rows[3][3] - 1))  # a smaller value at one time
    return rows + rows[5:9] + [("m", "c", rows[0][2], None)]


SAMPLE = "metric string, job string, ts_us long, value double"


def test_rates_of_a_table_equal_rates_on_the_grid(spark):
    frame = spark.createDataFrame(counter_rows(), SAMPLE)
    assert listed(rates.rates(frame, SERIES)) == listed(metrics.rate_on_grid(frame, SERIES))


def test_rates_of_a_stream_close_with_the_watermark(spark, tmp_path):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    rows, end = counter_rows(), 1_000_000_000_000_000 + 4_000_000_000
    late = [("m", "a", 1_000_000_000_000_000 + 500_000, 9.0)]
    batches = [rows, [("m", "z", end, 1.0)], late, [("m", "z", end + 1, 1.0)]]
    number = 0
    for part in batches:
        value = F.to_json(F.struct(*[c.split()[0] for c in SAMPLE.split(", ")]))
        write_log(spark.createDataFrame(part, SAMPLE).select(value.alias("value"), F.lit("samples").alias("topic")), log)
        messages = stream_log(spark, log, "rates", per_batch=1000, gather_ms=50)
        stream = messages.select(F.from_json(F.col("value").cast("string"), SAMPLE).alias("s")).select("s.*")
        query = rates.follow(stream, out, str(tmp_path / "checkpoint"), every=jobs.GATHERED, series=SERIES, lateness=60)
        jobs.drain(query)
        number += rates.late_rows(query)
    whole = metrics.rate_on_grid(spark.createDataFrame(rows, SAMPLE), SERIES)
    closed = whole.filter(F.col("at") <= (end // 30_000_000) - 2)
    assert listed(jobs.read_batches(spark, out, whole.schema).drop("batch_id")) == listed(closed)
    assert number == 10  # the late sample's instants


def test_ratio_of_spans_equals_the_ratio_at_every_instant(spark):
    choose = random.Random(9)
    rows = [
        (metric, job, 1_000_000_000_000_000 + i * 1_000_000 * choose.choice([20, 45, 400]), float(choose.randrange(0, 4)))
        for metric in ("used", "limit")
        for job in ("a", "b", None)
        for i in range(60)
    ]
    frame = spark.createDataFrame(rows, SAMPLE)
    spans = metrics.ratio_spans(metrics.sample_spans(frame, SERIES), "used", "limit", ["job"])
    grid = metrics.ratio(metrics.sample_on_grid(frame, SERIES), "used", "limit", ["job", "at"])
    got = metrics.at_instants(spans).select("job", "at", "value")
    assert list(map(repr, listed(got))) == list(map(repr, listed(grid.select("job", "at", "value"))))
    assert spans.filter("from_at > to_at").count() == 0


def test_ratio_rules_write_out_no_grid(spark, plan_of):
    frame = spark.createDataFrame([], "metric string, job string, cluster string, instance string, area string, ts_us long, value double")
    plan = plan_of(alerts.evaluate(frame, [r for r in alerts.ALERT_RULES if r.per]))
    assert "sequence(from_at" not in plan and "Window" in plan
