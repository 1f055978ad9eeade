import collections
import random

from bazaarlens.operators import topics
from bazaarlens.sources.topics import topic_options


def messages(spark, rows):
    return spark.createDataFrame(rows, "topic string, partition int, offset long, value string")


ROWS = [("t", 0, 5, "a"), ("t", 0, 7, "b"), ("t", 1, 1, "c"), ("u", 0, 2, "d")]


def test_offsets(spark):
    got = topics.offset_summary(messages(spark, ROWS)).orderBy("topic", "partition").collect()
    assert [tuple(r) for r in got] == [("t", 0, 5, 7, 8, 2), ("t", 1, 1, 1, 2, 1), ("u", 0, 2, 2, 3, 1)]


def test_next_message(spark):
    rows = messages(spark, ROWS)
    assert topics.next_message(rows, "t").first()["value"] == "a"
    seen = spark.createDataFrame([("t", 0, 6), ("u", 0, 0)], "topic string, partition int, next_offset long")
    assert topics.next_message(rows, "t", seen).first()["value"] == "b"
    done = topics.offset_summary(rows).select("topic", "partition", "next_offset")
    assert topics.next_message(rows, "t", done).first() is None
    assert topics.next_message(rows, "none").first() is None


def test_reconcile(spark):
    rng = random.Random(7)
    left = [("t", 0, rng.randrange(20), rng.choice("ab")) for _ in range(200)]
    right = [("t", 0, rng.randrange(20), rng.choice("ab")) for _ in range(200)]
    columns = ["topic", "partition", "offset", "value"]
    found = topics.reconcile(messages(spark, left), messages(spark, right), columns).collect()
    a, b = collections.Counter(left), collections.Counter(right)
    expected = {k: (max(a[k] - b[k], 0), max(b[k] - a[k], 0)) for k in {*a, *b} if a[k] != b[k]}
    assert {tuple(r)[:4]: tuple(r)[4:] for r in found} == expected
    assert topics.reconcile(messages(spark, left), messages(spark, left), columns).count() == 0


def test_reader_options():
    named = topic_options("h:1", ["a", "b"], 50)
    assert named["subscribe"] == "a,b" and named["startingOffsets"] == "earliest" and named["maxOffsetsPerTrigger"] == "50"
    assert topic_options("h:1", ".*")["subscribePattern"] == ".*"
