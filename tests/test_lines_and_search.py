import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bazaarlens import schemas
from bazaarlens.functions import text
from bazaarlens.functions.filtered_line import parse_line
from bazaarlens.operators import containment, search
from bazaarlens.sinks import files as file_sinks
from bazaarlens.sources import files

SAMPLE = """
{price={amount=310.5, currency=EUR}, product_id=A-17, name=Синий набор 1, category=Кухня}
{price={amount=42.0, currency=EUR}, product_id=B-02, name=Дубовый набор 2, category=Кухня}
{price={amount=1200.25, currency=EUR}, product_id=C-31, name=Набор ламп №5, category=Кухня}
"""


@pytest.fixture
def sample(spark, tmp_path):
    (tmp_path / "lines.txt").write_text(SAMPLE)
    return files.read_filtered_products(spark, str(tmp_path / "lines.txt"))


def parsed(spark, line):
    row = spark.createDataFrame([(line,)], "value string").select(*parse_line(F.col("value"))).first()
    return row["price"]["amount"], row["price"]["currency"], row["product_id"], row["name"], row["category"]


def test_sample_file(sample):
    rows = sample.orderBy("product_id").collect()
    assert [r["product_id"] for r in rows] == ["A-17", "B-02", "C-31"]
    assert [r["price"]["amount"] for r in rows] == [310.5, 42.0, 1200.25]
    assert {r["category"] for r in rows} == {"Кухня"}


@pytest.mark.parametrize(
    "line,expected",
    [
        ("price={amount=9999.99, currency=RUB}", (9999.99, "RUB", "", "", "")),
        ("price={amount=-5.0, currency=RUB}", (0.0, "", "", "", "")),
        ("price={amount=1.0E7, currency=RUB}", (0.0, "", "", "", "")),
        ("price={currency=RUB, amount=5}", (0.0, "", "", "", "")),
        ("price={amount=1.2.3, currency=RUB}", (1.2, "RUB", "", "", "")),
        ("price={amount=., currency=RUB}", (0.0, "", "", "", "")),
        ("price={amount=.5,currency=RUB}", (0.5, "RUB", "", "", "")),
        ("price={amount=" + "9" * 400 + ", currency=RUB}", (0.0, "", "", "", "")),
        ("{name=Lamp, large, category=X}", (0.0, "", "", "Lamp", "X")),
        ("{store_name=S, name=N}", (0.0, "", "", "S", "")),
        ("{category=null}", (0.0, "", "", "", "null")),
        ("{product_id=  7\t, name=　 n }", (0.0, "", "7", "n", "")),
    ],
)
def test_parse(spark, line, expected):
    assert parsed(spark, line) == expected


def test_only_line_feeds_end_lines(spark, tmp_path):
    (tmp_path / "x.txt").write_bytes("a\rb\r\n \t\n\x85c\n".encode())
    assert [r[0] for r in files.read_lines(spark, str(tmp_path / "x.txt")).collect()] == ["a\rb", "c"]


def test_written_lines_read_back(spark, tmp_path):
    rows = spark.createDataFrame(
        [((10.5, "RUB"), "1", "Lamp", "Home"), ((0.01, "USD"), "2", "Chair", None), (None, "3", "Desk", "Home")],
        schemas.FILTERED_PRODUCT,
    )
    path = str(tmp_path / "out")
    file_sinks.append_lines(rows, path)
    file_sinks.append_lines(rows.filter("product_id = '1'"), path)
    lines = [r[0] for r in spark.read.text(path).collect()]
    assert lines.count("{price={amount=10.5, currency=RUB}, product_id=1, name=Lamp, category=Home}") == 2
    back = sorted(map(tuple, files.read_filtered_products(spark, path).select("product_id", "name", "category", "price.amount").collect()))
    assert back == [("1", "Lamp", "Home", 10.5)] * 2 + [("2", "Chair", "null", 0.01), ("3", "Desk", "Home", 0.0)]


def test_json_products_as_lines(spark):
    cases = [
        (
            '{"name":"n","price":{"amount":5,"currency":"RUB"},"product_id":"1","category":null,"x":1}',
            "{price={amount=5, currency=RUB}, product_id=1, name=n, category=null}",
        ),
        ('{"product_id":"2","price":{"amount":10.0}}', "{price={amount=10.0}, product_id=2}"),
        ("raw text", "raw text"),
    ]
    rows = spark.createDataFrame([(a,) for a, _ in cases], "value string")
    got = [r[0] for r in rows.select(file_sinks.json_as_line(F.col("value"))).collect()]
    assert got == [b for _, b in cases]


def test_nested_rendering(spark):
    row = spark.sql("select array(1, null) as l, map('k', 'v') as m, named_struct('a', cast(null as string)) as s")
    line = file_sinks.as_lines(row, ["l", "m", "s"]).first()[0]
    assert line == "{l=[1, null], m={k=v}, s={a=null}}"


@pytest.mark.parametrize("needle,count", [("НАБОР", 3), ("", 3), ("часы", 0), ("набор 2", 1)])
def test_search(sample, needle, count):
    assert search.search(sample, needle).count() == count


def test_display(sample):
    shown = search.display(search.search(sample, "набор 1")).first()
    assert shown["price"] == "310.50 EUR"


def test_prices_round_like_printf(spark):
    rng = random.Random(11)
    values = [0.125, 0.375, 1.005, 1.015, 2.675, 0.005, 0.015, 10.0, 0.0, 99999999.995, 1e9, 1e15, 0.994999999, 8.345]
    values += [rng.randrange(10**7) / 1000 for _ in range(3000)] + [rng.random() * 100 for _ in range(500)]
    values += [rng.randrange(10**5) / 8 for _ in range(500)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    for places in (0, 2, 4):
        got = frame.select("v", text.fixed(F.col("v"), places).alias("t")).collect()
        assert [r["t"] for r in got] == [f"{v:.{places}f}" for v in values]
    row = spark.createDataFrame([(float("nan"), -2.5)], "a double, b double").select(
        text.fixed(F.col("a"), 2), text.fixed(F.col("b"), 0), text.price_label(F.col("b"), F.lit("RUB"))
    )
    assert tuple(row.first()) == ("NaN", "-2", "-2.50 RUB")


NAMES = ["Red ring", "small RING", "ringing bell", "", None, "a.b%c", "Red ring"]
TERMS = ["ring", "RING", "", "red", "b%", "zzz", "bell", None]


def brute(names, terms):
    return sorted(
        (i, t)
        for i, n in enumerate(names)
        for t in {t for t in terms if t is not None}
        if n is not None and t.lower() in n.lower()
    )


@pytest.mark.parametrize("inline", [True, False, None])
def test_search_many(spark, inline):
    products = spark.createDataFrame(list(enumerate(NAMES)), "i int, name string")
    terms = spark.createDataFrame([(t,) for t in TERMS + TERMS], "term string")
    found = search.search_many(products, terms, inline)
    assert sorted(map(tuple, found.select("i", "term").collect())) == brute(NAMES, TERMS)
    counts = dict(map(tuple, search.result_counts(products, terms, inline).collect()))
    expected = {t: sum(1 for _, x in brute(NAMES, TERMS) if x == t) for t in TERMS if t is not None}
    assert counts == expected


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    names=st.lists(st.text("aAbБб %\\_", max_size=6), min_size=1, max_size=8),
    terms=st.lists(st.text("aAbБб %\\_", max_size=4), min_size=1, max_size=6),
)
def test_both_ways_of_matching_agree(spark, names, terms):
    products = spark.createDataFrame(list(enumerate(names)), "i int, name string")
    wanted = spark.createDataFrame([(t,) for t in terms], "term string")
    for inline in (True, False):
        found = search.search_many(products, wanted, inline).select("i", "term")
        assert sorted(map(tuple, found.collect())) == brute(names, terms)


def test_long_lists_are_joined_by_equality(spark, plan_of):
    products = spark.createDataFrame([("a b",)], "name string")
    terms = spark.createDataFrame([("a",)], "term string")
    plan = plan_of(search.search_many(products, terms, inline=False))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert containment.inline(terms.withColumnRenamed("term", "folded_needle"))


@pytest.mark.parametrize("few", [0, 3, 100])
def test_index_finds_what_cutting_finds(spark, few):
    rng = random.Random(few)
    words = ["ring", "Lampe", "стол", "a", "", "x y", "aaaaaaaaaaaaaaa", "ringring lampe"]
    texts = sorted({" ".join(rng.choice(words) for _ in range(rng.randrange(6))) for _ in range(80)})
    needles = sorted({t[rng.randrange(5) :][: rng.randrange(14)] for t in texts} | {"", "ringx", "no such text at all", "aaaaaaaa"})
    left = spark.createDataFrame([(t,) for t in texts], "folded_text string")
    right = spark.createDataFrame([(n,) for n in needles], "folded_needle string")
    found = containment.containing_pairs(left, right, few).collect()
    assert sorted(map(tuple, found)) == sorted((t, n) for t in texts for n in needles if n in t)


def test_the_index_joins_no_more_than_rare_pieces(spark):
    """Many needles share common pieces; each is met in its rarest one only."""
    texts = spark.range(300).select(F.concat(F.lit("common words here "), F.col("id").cast("string"), F.lit("#")).alias("folded_text"))
    needles = texts.select(F.substring("folded_text", 8, 40).alias("folded_needle"))
    index = containment.posted(texts, 8)
    met = index.join(containment.rarest_grams(needles, index, 8), "gram").count()
    assert met < 300 * 12


def _held_against_brute_force(spark, texts, needles, lookup_rows, monkeypatch):
    monkeypatch.setattr(containment, "is_small", lambda df: df.count() <= lookup_rows)
    left = spark.createDataFrame([(t,) for t in texts], "folded_text string")
    right = spark.createDataFrame([(n, k) for k, n in enumerate(needles)], "folded_needle string, place int")
    found = containment.occurrences(left, right)
    assert found.columns == ["folded_text", "folded_needle", "place"]
    want = {(t, n, k) for t in texts for k, n in enumerate(needles) if n in t}
    assert {tuple(r) for r in found.collect()} == want
    return found


@pytest.mark.parametrize("lookup_rows", [100, 1])
@pytest.mark.parametrize("needles", [["", "ab", "abc", "ab", "zzz", "é b"], [""], [], ["abcabcabcabc"], [chr(97) * n for n in range(1, 22)]])
def test_occurrences_by_the_beginnings_of_needles(spark, monkeypatch, needles, lookup_rows):
    texts = ["", "a", "ab", "abcabc", "xxab", "é b", "b", "aaaaaaaaaaaaaaaaaaaaaaa"]
    _held_against_brute_force(spark, texts, needles, lookup_rows, monkeypatch)


def test_only_substrings_that_begin_like_a_needle_are_cut(spark):
    texts = spark.createDataFrame([("x" * 200 + f"needle {k}",) for k in range(5)], "folded_text string")
    needles = spark.createDataFrame([("needle 1",), ("needle 22",)], "folded_needle string")
    assert containment._starting(texts, needles, [8, 9]).count() == 2  # "needle 1" and "needle 2"
