import base64
import json

import pytest
from pyspark.sql import functions as F

from bazaarlens import schemas
from bazaarlens.functions import text
from bazaarlens.operators import popularity, recommend, requests
from bazaarlens.sinks import files as file_sinks
from bazaarlens.sources import files

POPULAR = ["Ring", "plate", "rod"]


def popular_frame(spark, names):
    return spark.createDataFrame([(i, n, 10 - i) for i, n in enumerate(names, 1)], schemas.POPULAR)


def sealed(text):
    return json.dumps(base64.b64encode(text.encode()).decode())


GOOD = '{"product_name":"a","timestamp":"t"}'
PAYLOADS = [
    (GOOD, ("a", "t")),
    (" " + GOOD + "\n", ("a", "t")),
    (sealed(GOOD), ("a", "t")),
    (sealed(json.dumps({"product_name": "ю" * 200, "timestamp": "t"})), ("ю" * 200, "t")),
    ('"not base64!"', None),
    (sealed('{"product_name":"a"}').replace("=", ""), None),
    ('{"timestamp":"t"}', ("", "t")),
    ('{"product_name":null}', ("", "")),
    ("{}", ("", "")),
    ('{"product_name":5}', None),
    ('{"product_name":"a","timestamp":[]}', None),
    ("null", None),
    (sealed("null"), ("", "")),
    (sealed(""), None),
    ("garbage", None),
    ("", None),
    (None, None),
    ("[1]", None),
    ("5", None),
    (GOOD + " tail", None),
    (GOOD + "}", None),
    (GOOD + "] [", None),
    (GOOD + "} {", None),
    (GOOD + "," + GOOD, None),
    ('{"product_name":"a}b","timestamp":"{t}"}', ("a}b", "{t}")),
    ('{"product_name":"a","x":{"y":[1,{"z":"}"}]}}', ("a", "")),
    ('{"Product_Name":"a","TIMESTAMP":"t"}', ("a", "t")),
    ('{"product_name":"a","product_name":"b"}', ("b", "")),
    (json.dumps('"' + base64.b64encode(GOOD.encode()).decode() + '"'), ("a", "t")),
    (json.dumps(base64.b64encode(GOOD.encode()).decode()[:8] + "\r\n" + base64.b64encode(GOOD.encode()).decode()[8:]), ("a", "t")),
    (json.dumps(GOOD), None),
]


def test_decode(spark):
    rows = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(PAYLOADS)], "i int, value string")
    found = requests.decode_requests(rows).orderBy("i").collect()
    for row, (payload, expected) in zip(found, PAYLOADS, strict=True):
        got = (row["product_name"], row["timestamp"]) if row["decoded"] else None
        assert got == expected, payload


def test_split_keeps_every_message(spark):
    rows = spark.createDataFrame([(p,) for p, _ in PAYLOADS], "value string")
    good, bad = requests.split_decoded(rows)
    assert good.count() == sum(e is not None for _, e in PAYLOADS)
    assert bad.count() == sum(e is None for _, e in PAYLOADS)


def test_envelope_round_trip(spark):
    rows = spark.sql("select 'a \"q\" ю' as product_name, timestamp'2024-01-01 00:00:05' as ts")
    row = requests.decode_requests(requests.request_envelope(rows).select("value")).first()
    assert (row["product_name"], row["timestamp"]) == ('a "q" ю', "2024-01-01T00:00:05Z")


def test_very_long_payloads(spark):
    text = json.dumps({"product_name": "x" * 200_000})
    rows = spark.createDataFrame([(sealed(text),), (json.dumps("\\" * 50_000),)], "value string")
    assert [r["decoded"] for r in requests.decode_requests(rows).collect()] == [True, False]


def test_popularity(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("",)], "product_name string")
    got = [tuple(r) for r in popularity.popular_products(rows).collect()]
    assert got == [(1, "a", 2), (2, "", 1), (3, "b", 1)]
    assert [r["product_name"] for r in popularity.popular_products(rows, 1).collect()] == ["a"]
    assert popularity.popular_products(rows.limit(0)).count() == 0
    with pytest.raises(ValueError):
        popularity.popular_products(rows, 0)


def test_popularity_plan(spark, plan_of):
    plan = plan_of(popularity.popular_products(spark.createDataFrame([("a",)], "product_name string")))
    assert "TakeOrderedAndProject" in plan and "partial_count" in plan and "Window" not in plan


GOLDEN = [
    ("hot ring plate", POPULAR, "Ring - Popular", POPULAR),
    ("ri", POPULAR, "Ring - Trending", POPULAR),
    ("Ring", POPULAR, "Ring - Popular", ["plate", "rod"]),
    ("ring", POPULAR, "Ring - Popular", POPULAR),
    ("a PLATE", POPULAR, "plate - Popular", POPULAR),
    ("", POPULAR, "Ring - Trending", POPULAR),
    (None, POPULAR, "Ring - Trending", POPULAR),
    ("x", [], "x - Recommended", ["alt_1", "alt_2", "alt_3"]),
    (None, [], " - Recommended", ["alt_1", "alt_2", "alt_3"]),
    ("Ring", ["Ring"], "Ring - Popular", ["alt_1", "alt_2", "alt_3"]),
    ("rod", ["a", "b", "rod", "c"], "rod - Popular", ["a", "b"]),
    ("c", ["a", "b", "rod", "c"], "c - Popular", ["a", "b", "rod"]),
    ("c", ["C", "c"], "C - Popular", ["C"]),
    ("anything", [None, "z"], " - Popular", ["", "z"]),
]


@pytest.mark.parametrize("inline", [True, False])
def test_recommend(spark, inline):
    for popular in {json.dumps(p) for _, p, _, _ in GOLDEN}:
        cases = [(t, e, a) for t, p, e, a in GOLDEN if json.dumps(p) == popular]
        rows = spark.createDataFrame([(i, c[0], "t") for i, c in enumerate(cases)], "i int, product_name string, timestamp string")
        frame = popular_frame(spark, json.loads(popular))
        found = recommend.recommend(rows, frame, keep=["i"], inline=inline).orderBy("i").collect()
        assert len(found) == len(cases)
        for row, (term, expected, alternatives) in zip(found, cases, strict=True):
            assert row["product_name"] == expected, (term, popular)
            assert row["product_id"] == f"rec_{expected}"
            assert row["alternatives"] == alternatives, (term, popular)
            assert (row["reason"], row["confidence"], row["timestamp"]) == ("Popular recommendation", 0.9, "t")


def test_recommend_measures_the_list(spark, plan_of):
    rows = spark.createDataFrame([("Ring", "t")], "product_name string, timestamp string")
    short = plan_of(recommend.recommend(rows, popular_frame(spark, POPULAR)))
    assert "Join" not in short.split("Subquer")[0]
    long = popular_frame(spark, [f"name {i}" for i in range(2000)])
    found = recommend.recommend(rows, long)
    plan = plan_of(found)
    assert "Join" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert found.first()["product_name"] == "name 0 - Trending"


def test_last_write_wins(spark):
    rows = spark.sql(
        """select * from values
        ('a', timestamp'2024-01-01 00:00:05.1', 1, 'x'), ('a', timestamp'2024-01-01 00:00:05.9', 2, 'y'),
        ('a', timestamp'2024-01-01 00:00:05.9', 3, 'z'), ('a', timestamp'2024-01-01 00:00:06', 4, 'w'),
        ('b', timestamp'2024-01-01 00:00:05', 5, null) as t(id, ts, n, payload)"""
    )
    kept = requests.last_write(rows, "id", "ts", ["n"], ["payload"]).orderBy("file_name").collect()
    assert [(r["file_name"], r["writes"], r["payload"]) for r in kept] == [
        ("a_20240101_000005_000.json", 3, "z"),
        ("a_20240101_000006_000.json", 1, "w"),
        ("b_20240101_000005_000.json", 1, None),
    ]


def test_archive_and_popular_list_round_trip(spark, tmp_path):
    base = str(tmp_path)
    assert files.read_requests(spark, base).count() == 0
    assert files.read_popular(spark, base).count() == 0
    rows = spark.sql("select 'a' as product_name, '2024-01-01T00:00:00Z' as timestamp, timestamp'2024-01-01' as ts")
    file_sinks.archive(rows, base + "/requests", "ts")
    file_sinks.archive(rows, base + "/requests", "ts")
    from bazaarlens.streaming.jobs import refresh_once

    for _ in range(2):
        assert [tuple(r) for r in refresh_once(spark, base).collect()] == [(1, "a", 2)]


def test_requests_archive_tolerates_odd_records(spark, tmp_path):
    (tmp_path / "requests").mkdir()
    (tmp_path / "requests" / "x.json").write_text('{"product_name":"a"}\nbroken\n{"other":1}\n')
    rows = files.read_requests(spark, str(tmp_path))
    assert [tuple(r) for r in popularity.popular_products(rows).collect()] == [(1, "a", 1)]


def test_files(spark, tmp_path):
    (tmp_path / "a.json").write_text("[1]")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.json").write_text("[2]")
    listed = files.list_files(spark, str(tmp_path)).collect()
    assert [(r["path"].split("/")[-1], r["length"]) for r in listed] == [("a.json", 3)]
    assert bytes(files.read_file(spark, str(tmp_path / "sub")).first()["content"]) == b"[2]"


def test_messages_keep_nulls(spark):
    from bazaarlens.sinks.topics import as_messages

    rows = spark.createDataFrame([("1", "n", None)], "product_id string, name string, brand string")
    message = as_messages(rows, "products").first()
    assert json.loads(message["value"]) == {"product_id": "1", "name": "n", "brand": None}
    assert message["topic"] == "products"


def test_term_counts_has_partial_aggregate_for_hot_terms(spark):
    rows = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("product_name"))
    top = popularity.popular_products(rows, 1).first()
    assert (top["product_name"], top["search_count"]) == ("hot", 100_000)


def test_long_lists_are_ranked_whole(spark):
    """More than any list that fits an array: every rank is there, ties by term."""
    requests = spark.range(0, 25_000).selectExpr("concat('t', id % 12000) as product_name")
    whole = popularity.popular_products(requests, None).collect()
    counts = {f"t{i}": 3 if i < 1000 else 2 for i in range(12000)}
    want = sorted(counts.items(), key=lambda c: (-c[1], c[0]))
    assert sorted((r["rank"], r["product_name"], r["search_count"]) for r in whole) == [
        (k, name, n) for k, (name, n) in enumerate(want, 1)
    ]
    some = popularity.popular_products(requests, 11_000).collect()
    assert sorted(r["rank"] for r in some) == list(range(1, 11_001))
    short = popularity.popular_products(requests, 5).collect()
    assert [r["product_name"] for r in sorted(short, key=lambda r: r["rank"])] == [name for name, _ in want[:5]]


def test_case_is_folded_letter_by_letter(spark):
    row = spark.createDataFrame([("ΟΔΟΣΑ", "ΟΔΟΣ")], "a string, b string").select(text.contains_fold(F.col("a"), F.col("b")))
    assert row.first()[0]
