"""Plan guards: what must never appear in a registered query, and what must."""

import pytest

from tests.conftest import SF
from tradelane import registry
from tradelane.standin import Standin

QUERIES = registry.queries()
IO = ("src_", "sink_", "stream_", "table_snapshot")
NAMES = [n for n in QUERIES if not n.startswith(IO)]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for node in ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, node


def test_dedupe_is_limited_before_the_shuffle(spark):
    plan = plan_of(Standin(spark, SF).vessels_daily)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_columns_and_filters_reach_the_scan(spark):
    plan = plan_of(QUERIES["q01_top_exporters"](spark, SF))
    line = next(x for x in plan.splitlines() if "lineitem.parquet" in x)
    assert "l_discount" not in line and "l_shipdate" not in line
    assert "IsNotNull(l_orderkey)" in line


def test_results_do_not_depend_on_partitioning(spark):
    names = ("mart_bdi_trade", "mart_port_risk_trade", "current_vs_historical", "union_sources")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append([sorted(map(repr, QUERIES[x](spark, SF).collect())) for x in names])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]


def test_every_port_at_risk_is_in_the_result(spark):
    from tradelane.plans import queries
    ports = spark.createDataFrame([(f"P{i:02}", "CN" if i < 14 else "DE", i % 13, i != 3) for i in range(20)],
                                  "port_name string, country_iso string, beaufort_number int, port_risk_flag boolean")
    got = [r.port_name for r in queries.q14_ports_at_risk(ports).collect()]
    assert sorted(got) == [f"P{i:02}" for i in range(14) if i != 3] and got[0] == "P12"
