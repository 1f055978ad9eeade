import json

import pytest

from bazaarlens import schemas
from bazaarlens.operators import catalog
from bazaarlens.sources import files

ROUTES = [
    (None, "pass_null"),
    ('{"product_id":"10001","name":"a"}', "keep"),
    ('{"product_id":10001}', "keep"),
    ('{"product_id":10001.0}', "drop_not_allowed"),
    ('{"product_id":"99"}', "drop_not_allowed"),
    ('{"product_id":null}', "drop_not_allowed"),
    ('{"name":"a"}', "drop_no_id"),
    ("[1]", "drop_no_id"),
    ("not json", "pass_unparsed"),
    ("", "drop_no_id"),
    (" \n", "drop_no_id"),
    ('{"product_id":"10001"} tail', "keep"),
    ('{"product_id":"1","product_id":"10001"}', "keep"),
    ('{"product_id":true}', "drop_not_allowed"),
    ('{"product_id":{"a":1}}', "drop_not_allowed"),
    ("{'product_id':'10001'}", "pass_unparsed"),
    ("null", "drop_no_id"),
    ("5", "drop_no_id"),
]


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "product_id string")


def test_routes(spark):
    rows = spark.createDataFrame(list(enumerate(v for v, _ in ROUTES)), "i int, value string")
    routed = catalog.route_records(rows, ids(spark, "10001")).orderBy("i").collect()
    assert [(r["value"], r["route"]) for r in routed] == ROUTES


def test_routes_cover_input_and_filter_keeps_the_passing_ones(spark):
    rows = spark.createDataFrame(list(enumerate(v for v, _ in ROUTES)), "i int, value string")
    kept = catalog.filtered(rows, ids(spark, "10001"))
    passing = sum(not route.startswith("drop") for _, route in ROUTES)
    assert kept.count() == passing
    assert catalog.route_records(rows, ids(spark, "10001")).count() == len(ROUTES)


def test_routes_behind_a_converter(spark):
    cases = [
        ("[1]", "pass_unsupported"),
        ("5", "pass_unsupported"),
        ("true", "pass_unsupported"),
        ("null", "pass_null"),
        ('{"product_id":10001}', "keep"),
        ('"{\\"product_id\\":\\"10001\\"}"', "keep"),
        ('"text"', "pass_unparsed"),
        ('""', "drop_no_id"),
    ]
    rows = spark.createDataFrame(list(enumerate(v for v, _ in cases)), "i int, value string")
    routed = catalog.route_records(rows, ids(spark, "10001"), converted=True).orderBy("i").collect()
    assert [(r["value"], r["route"]) for r in routed] == cases


@pytest.mark.parametrize(
    "text,expected",
    [
        ('{"raw": {"product_id": "x"}}', "drop_no_id"),
        ('{"product_id": 123456789012345678901234567890}', "keep"),
        ('{"product_id": 1e4}', "keep"),
        ('{"product_id": 1.50}', "keep"),
        ('{"product_id": -0}', "keep"),
        ('{"product_id": false}', "keep"),
    ],
)
def test_id_text(spark, text, expected):
    listed = ids(spark, "123456789012345678901234567890", "10000.0", "1.5", "0", "false")
    row = catalog.route_records(spark.createDataFrame([(text,)], "value string"), listed).first()
    assert row["route"] == expected


def test_missing_or_broken_list_drops_everything(spark, tmp_path):
    (tmp_path / "broken.json").write_text('{"allowed_product_ids": ["10001", ')
    (tmp_path / "other.json").write_text('{"allowed_product_ids": "10001"}')
    (tmp_path / "absent.json").write_text('{"ids": []}')
    rows = spark.createDataFrame([('{"product_id":"10001"}',)], "value string")
    for name in ("missing.json", "broken.json", "other.json", "absent.json"):
        allowed = files.read_allow_list(spark, str(tmp_path / name))
        assert allowed.count() == 0, name
        assert catalog.filtered(rows, allowed).count() == 0


def test_allow_list_elements_become_text(spark, tmp_path):
    (tmp_path / "list.json").write_text('{\n "allowed_product_ids": ["10001", 7, null, true, 1.0]\n}')
    rows = files.read_allow_list(spark, str(tmp_path / "list.json")).orderBy("position").collect()
    assert [r["product_id"] for r in rows] == ["10001", "7", "null", "true", "1.0"]


def test_semi_and_anti_join_split_the_products(spark, plan_of):
    products = ids(spark, "1", "2", "2", "3")
    allowed = ids(spark, "2", "2", "9")
    kept = catalog.allowed_only(products, allowed)
    assert sorted(r[0] for r in kept.collect()) == ["2", "2"]
    assert sorted(r[0] for r in catalog.without_denied(products, allowed).collect()) == ["1", "3"]
    assert "BroadcastHashJoin" in plan_of(kept)


def test_large_list_is_not_broadcast_and_a_hot_id_is_split(spark):
    from bazaarlens.session import lookup_join

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(0, 300_000, 1, 8).selectExpr(
            "case when id % 3 = 0 then 'hot' else cast(id as string) end as product_id", "uuid() as payload"
        )
        listed = spark.range(0, 200_000).selectExpr("case when id = 0 then 'hot' else cast(id as string) end as product_id")
        kept = lookup_join(rows, listed, ["product_id"], "left_semi", max_rows=1000)
        expected = 100_000 + sum(1 for i in range(1, 200_000) if i % 3)
        assert len(kept.collect()) == expected
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
        assert "BroadcastHashJoin" not in plan
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def listing(df):
    return [(r["line"], r["product_id"]) for r in catalog.numbered(df).orderBy("line").collect()]


def test_list_edits(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, "c")], schemas.ALLOW_LIST)
    added = catalog.add_ids(base, spark.createDataFrame([(7, "a"), (8, "x"), (9, "x"), (10, "y")], schemas.ALLOW_LIST))
    assert listing(added) == [(1, "a"), (2, "b"), (3, "b"), (4, "c"), (5, "x"), (6, "y")]
    removed = catalog.remove_ids(added, ids(spark, "b"), check=True)
    assert listing(removed) == [(1, "a"), (2, "c"), (3, "x"), (4, "y")]
    with pytest.raises(ValueError, match="'q'"):
        catalog.remove_ids(base, ids(spark, "a", "q"), check=True)
    assert catalog.clear_ids(base).count() == 0
    unchanged = catalog.add_ids(base, spark.createDataFrame([(1, "c")], schemas.ALLOW_LIST))
    assert listing(unchanged) == listing(base)
    from_empty = catalog.add_ids(catalog.clear_ids(base), spark.createDataFrame([(5, "n")], schemas.ALLOW_LIST))
    assert listing(from_empty) == [(1, "n")]


VALID = {
    "product_id": "1",
    "name": "Lamp",
    "price": {"amount": 5, "currency": "RUB"},
    "stock": {"available": 5.0},
    "tags": ["a"],
    "images": [{"url": "u"}, {}],
    "specifications": {"k": 1},
    "extra": None,
}


@pytest.mark.parametrize(
    "change,violations",
    [
        ({}, []),
        ({"product_id": None}, ["product_id"]),
        ({"product_id": 5}, ["product_id"]),
        ({"price": {"amount": 5}}, ["price"]),
        ({"price": {"amount": "5", "currency": "RUB"}}, ["price"]),
        ({"price": 7}, ["price"]),
        ({"stock": {"available": 1.5}}, ["stock"]),
        ({"stock": {"reserved": None}}, ["stock"]),
        ({"tags": ["a", 1]}, ["tags"]),
        ({"tags": []}, []),
        ({"images": [{"alt": 1}]}, ["images"]),
        ({"images": "x"}, ["images"]),
        ({"specifications": []}, ["specifications"]),
        ({"brand": None, "sku": 3}, ["brand", "sku"]),
    ],
)
def test_validation(spark, change, violations):
    text = json.dumps({**VALID, **change})
    row = catalog.validate_products(spark.createDataFrame([(text,)], "value string")).first()
    assert sorted(row["violations"]) == sorted(violations)
    assert row["valid"] == (not violations)


def test_catalog_file(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([VALID | {"specifications": {"k": "v"}, "stock": {"available": 5}}, {"product_id": "2"}]))
    rows = files.read_catalog(spark, str(tmp_path / "a.json")).orderBy("product_id").collect()
    assert [(r["product_id"], r["name"]) for r in rows] == [("1", "Lamp"), ("2", "")]
    assert rows[0]["price"]["amount"] == 5.0 and rows[0]["images"][0]["url"] == "u"
    (tmp_path / "bad.json").write_text('[{"product_id":"1","price":"cheap"}]')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        files.read_catalog(spark, str(tmp_path / "bad.json")).collect()
    (tmp_path / "lines.json").write_text('{"product_id":"1","name":"a"}\n{"product_id":"2","name":"b"}\n')
    assert files.read_catalog(spark, str(tmp_path / "lines.json"), lines=True).count() == 2
