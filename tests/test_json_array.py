import json
import random

import pytest

from bazaarlens import schemas
from bazaarlens.sources.files import read_catalog
from bazaarlens.sources.json_array import elements


def products(count):
    rng = random.Random(count)
    odd = ['a "quoted" name', "braces } { ] [", "back\\slash\\", "\\\"}", "юникод }", "", "line\nbreak", '"']
    out = []
    for i in range(count):
        row = {"product_id": str(i), "name": rng.choice(odd) + str(i)}
        if rng.random() < 0.6:
            row["price"] = {"amount": i / 2, "currency": rng.choice(["RUB", "}"])}
            row["tags"] = [rng.choice(odd) for _ in range(rng.randrange(4))]
            row["images"] = [{"url": rng.choice(odd), "alt": "x"}] * rng.randrange(3)
            row["specifications"] = {rng.choice(odd): rng.choice(odd)}
        out.append(row)
    return out


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("split", ["64", "1000", "1m"])
def test_elements_of_an_array_over_many_splits(spark, tmp_path, indent, split):
    rows = products(120)
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=False))
    (tmp_path / "b.json").write_text(" [ ]\n")
    (tmp_path / "c.json").write_text(json.dumps(rows[:1]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = [(r["file"][-6:], r["number"], json.loads(r["value"])) for r in elements(spark, str(tmp_path)).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert sorted((f, n) for f, n, _ in found) == [("a.json", i) for i in range(120)] + [("c.json", 0)]
    assert all(v == rows[n] for _, n, v in found)


@pytest.mark.parametrize("text", ['[{"product_id": "1", "name": 5.5}, {"product_id": }]', '[{"product_id": "1"} {"product_id": "2"}]', '[{"product_id": "1"}', '[1, {"product_id": "1"}]', '[{"product_id": "1"}] tail'])
def test_one_bad_element_fails_the_load(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception):
        read_catalog(spark, str(tmp_path / "a.json")).collect()


def test_catalog_rows(spark, tmp_path):
    rows = products(40)
    (tmp_path / "a.json").write_text(json.dumps(rows))
    found = read_catalog(spark, str(tmp_path / "a.json"))
    assert [f.name for f in found.schema.fields] == [f.name for f in schemas.PRODUCT.fields]
    by_id = {r["product_id"]: r for r in found.collect()}
    assert {i: r["name"] for i, r in by_id.items()} == {p["product_id"]: p["name"] for p in rows}
    assert all((by_id[p["product_id"]]["tags"] or []) == p.get("tags", []) for p in rows)
