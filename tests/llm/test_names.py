"""Tables whose columns have the names that operators use inside."""

from __future__ import annotations

import random

import pytest
from bazaarlens.llm import decontaminate, line_windows, quality, simhash

NAMES = "key reference _row _key _doc _text_key _later _found _fingerprint _group _id _f _rows n low high part r a.b n_words items".split()


@pytest.fixture(scope="module")
def docs(spark):
    chosen = random.Random(1)
    line = lambda: " ".join(f"w{chosen.randrange(60)}" for _ in range(12))
    texts = ["\n".join(line() for _ in range(8)) for _ in range(20)] + ["", None]
    texts += [texts[0], texts[1] + "\nmore"]
    names = ", ".join(f"`{n}` string" for n in NAMES)
    rows = [(i, t, "en", *[f"{n}{i}" for n in NAMES]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, {names}")


def test_stages_keep_all_columns(spark, docs):
    benchmark = spark.createDataFrame([("i", "one two three four five six seven eight nine ten eleven twelve thirteen")], "item_id string, text string")
    stages = [quality.keep_good, line_windows.dedup_lines, simhash.keep_one, lambda d: decontaminate.clean(d, benchmark)]
    for stage in stages:
        out = stage(docs)
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows
        for row in rows:
            assert [row[n] for n in NAMES] == [f"{n}{row['doc_id']}" for n in NAMES]
    assert line_windows.dedup_lines(docs).count() == docs.count()


def test_blocks_of_the_benchmark_give_the_same_hits(spark, docs):
    items = [(f"i{r['doc_id']}", r["text"]) for r in docs.filter("text <> ''").limit(9).collect()]
    benchmark = spark.createDataFrame([*items, ("none", None), ("short", "w1 w2")], "item_id string, text string")
    plain = docs.select("doc_id", "text")
    whole = decontaminate.measures(decontaminate.search(plain, benchmark)).collect()
    blocks = decontaminate.measures(decontaminate.search(plain, benchmark, block_bytes=1000)).collect()
    assert sorted(map(str, whole)) == sorted(map(str, blocks))
    assert sum(r["contaminated"] for r in whole) >= 9


def test_a_task_holds_one_block(spark, docs, plan_of):
    benchmark = spark.createDataFrame([(str(i), "text of words " * 20) for i in range(9)], "item_id string, text string")
    found = decontaminate.search(docs.select("doc_id", "text"), benchmark, block_bytes=300)
    assert plan_of(found).count("MapInArrow") == 1
