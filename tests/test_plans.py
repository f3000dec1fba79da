"""Physical plans: what must and must not be in them."""

import pytest

from plan_text import plan
from testbed import queries

SF = "/root/testdata/sf0.001"

# The compiler of the JVM leaves larger methods uncompiled, which makes them ten times slower.
COMPILED_LIMIT = 8000

# Queries that write tables on their way take long and are read back by plain scans.
WRITING = ("stream", "stored", "fact_roundtrip", "fact_from", "fact_of", "fact_accumulated", "fact_incremental", "fact_published", "documents_additive")
BATCH = sorted(n for n in queries.ALL if not n.startswith(WRITING))


@pytest.fixture(scope="module")
def static_plans(spark):
    """Plans as they are before run-time changes, with generated code to look at."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield {n: queries.ALL[n](spark, SF) for n in BATCH}
    spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(static_plans, name):
    text = plan(static_plans[name])
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "InPandas"):
        assert operator not in text


@pytest.mark.parametrize("name", BATCH)
def test_generated_code_can_be_compiled(spark, static_plans, name):
    debug = getattr(getattr(spark.sparkContext._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    stages = debug.codegenStringSeq(static_plans[name]._jdf.queryExecution().executedPlan())
    sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    assert max(sizes) < COMPILED_LIMIT


@pytest.mark.parametrize("name", ["station_list", "bus_history", "bus_history_unlimited"])
def test_lookups_without_latest_positions_run_no_job_before(spark, monkeypatch, name):
    monkeypatch.setattr(queries, "latest", lambda *_: pytest.fail("not needed"))
    queries.ALL[name](spark, SF)


@pytest.mark.parametrize("name", ["positions_all", "near_point", "near_station_eta", "buses_by_route", "buses_of_route"])
def test_listings_are_not_numbered_in_one_task(static_plans, name):
    assert "SinglePartition" not in plan(static_plans[name]) and "Window" not in plan(static_plans[name])


def test_only_needed_columns_are_read(static_plans):
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in plan(static_plans["usable_routes"])
    assert "props" not in plan(static_plans["geojson_points"]).split("ReadSchema")[1]


def test_counts_shrink_before_joining(static_plans):
    text = plan(static_plans["bus_count_per_route"])
    assert text.index("Join") < text.rindex("HashAggregate")  # an aggregate below the join


def test_a_report_on_one_route_filters_before_joining(static_plans):
    text = plan(static_plans["official_stops_of_route"])
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)" in text
    assert text.rindex("codigo") > text.index("Join")
