"""Every registered query against its SQL twin, and rules its plan must keep."""

import pytest
from check_oracle import compare, connect

import __spark_entry__ as entry_points
from bazaarlens.plans import registry, views

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    assert compare(spark, duck, SF, name) == ""


@pytest.mark.parametrize("name", sorted(views.SCHEMAS))
def test_stated_schemas_are_those_of_the_tables(spark, name):
    stated = views.table(spark, SF, name).schema
    assert stated == spark.read.parquet(f"{SF}/{name}.parquet").schema


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_query_has_a_twin():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(n for n in registry.queries() if not n.startswith("stream")))
def test_plan(spark, plan_of, name):
    plan = plan_of(entry_points.queries()[name](spark, SF))
    for word in ("CartesianProduct", "NestedLoopJoin", "Python", "RDDScan"):
        assert word not in plan


def test_scans_are_narrow_and_filtered(spark):
    def scans(name):
        text = spark._jvm.PythonSQLUtils.explainString(
            entry_points.queries()[name](spark, SF)._jdf.queryExecution(), "formatted"
        )
        return text

    text = scans("term_counts")
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in text
    text = scans("status_latest")
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in text
    assert "EqualTo(event_type,error)" in text
