"""Registered queries against their SQL twins, and the row counts of the others."""

import pytest
from bazaarlens.llm.queries import QUERIES
from check_oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert compare(spark, duck, SF, name) == ""


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in ("op3_html_extraction", "op4_chat_formatting", "op12_embedding_whitening")))
def test_one_row_per_document(spark, duck, name):
    rows = QUERIES[name][0](spark, SF).select("doc_id").collect()
    ids = duck.execute("select doc_id from documents").fetchall()
    assert sorted(r["doc_id"] for r in rows) == sorted(i for (i,) in ids)


def test_library_does_not_import_this_package():
    import pathlib
    import re

    import bazaarlens

    root = pathlib.Path(bazaarlens.__file__).parent
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert not re.search(r"^\s*(from|import)\s.*\bllm\b", path.read_text(), re.MULTILINE), path
