import json

import pytest

from bazaarlens.__main__ import main, parser, run

LINES = "{price={amount=10.5, currency=RUB}, product_id=1, name=Big Lamp, category=Home}\n"


def do(spark, *words):
    return [tuple(r) for r in run(spark, parser().parse_args([str(w) for w in words])).collect()]


def test_allow_list_jobs(spark, tmp_path):
    (tmp_path / "list.json").write_text('{"allowed_product_ids": ["a", "b", "a"]}')
    table = tmp_path / "table"
    assert do(spark, "import-list", tmp_path / "list.json", table) == [(1, "a"), (2, "b"), (3, "a")]
    assert do(spark, "add", table, "c", "b", "d") == [(1, "a"), (2, "b"), (3, "a"), (4, "c"), (5, "d")]
    assert do(spark, "remove", table, "a") == [(1, "b"), (2, "c"), (3, "d")]
    with pytest.raises(ValueError, match="'x'"):
        do(spark, "remove", table, "x")
    assert do(spark, "list", table) == [(1, "b"), (2, "c"), (3, "d")]
    assert do(spark, "clear", table) == []
    assert do(spark, "add", table, "z") == [(1, "z")]


def test_search_job(spark, tmp_path):
    (tmp_path / "lines.txt").write_text(LINES)
    assert do(spark, "search", tmp_path / "lines.txt", "LAMP") == [("1", "Big Lamp", "Home", "10.50 RUB")]


def test_a_search_joins_the_archive(spark, tmp_path):
    (tmp_path / "lines.txt").write_text(LINES)
    for name in ("LAMP", "lamp", "LAMP"):
        do(spark, "search", tmp_path / "lines.txt", name, "--log", tmp_path / "base")
    assert do(spark, "popular", tmp_path / "base") == [(1, "LAMP", 2), (2, "lamp", 1)]


def test_all_rows_are_printed(spark, tmp_path, capsys):
    ids = [f"id{k:03d}" for k in range(45)]
    (tmp_path / "list.json").write_text(json.dumps({"allowed_product_ids": ids}))
    main(["import-list", str(tmp_path / "list.json"), str(tmp_path / "table")])
    printed = capsys.readouterr().out.splitlines()
    assert printed == ["line\tproduct_id", *[f"{k}\t{i}" for k, i in enumerate(ids, 1)]]


def test_popular_and_recommend_jobs(spark, tmp_path):
    (tmp_path / "requests").mkdir()
    terms = ["lamp", "lamp", "red lamp", None]
    text = "".join(json.dumps({"product_name": t, "timestamp": "t"}) + "\n" for t in terms)
    (tmp_path / "requests" / "x.json").write_text(text)
    assert do(spark, "popular", tmp_path) == [(1, "lamp", 2), (2, "red lamp", 1)]
    found = sorted(json.loads(value)["product_name"] for value, _ in do(spark, "recommend", tmp_path))
    assert found == ["lamp - Popular"] * 3 + ["lamp - Trending"]
