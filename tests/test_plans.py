"""Plan-quality regression tests: what the physical plans must (not) contain."""

import contextlib
import io
import os
import re

import pytest

import __spark_entry__ as E
from peerscope.plans import catalog

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_flagship_pushdown_pruning_and_eliminated_branches(spark):
    p = plan(E.queries()["kpi_by_place_year"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01" in p  # time filter reaches the scan
    li = [line for line in p.splitlines() if line.startswith("ReadSchema: struct<l_orderkey")]
    assert li and "l_quantity" not in li[0] and "l_discount" not in li[0]  # column pruning
    assert "Expand" not in p and "SortAggregate" not in p  # distinct counts and mode branches dropped


def test_profile_year_is_a_scan_range(spark):
    p = plan(E.queries()["place_profile"](spark, SF))
    assert "LessThan(o_orderdate,1999-01-01" in p


def test_latest_per_key_limits_before_the_shuffle(spark):
    p = plan(E.queries()["latest_per_key"](spark, SF))
    assert p.count("WindowGroupLimit") >= 2  # partial (map side) and final


def test_matching_has_no_join(spark):
    p = plan(E.queries()["match_place_six"](spark, SF))
    assert "Join" not in p and "CartesianProduct" not in p


def test_no_cartesian_anywhere(spark):
    for name, fn in catalog.queries().items():
        if name == "file_stream_ingest":
            continue
        p = plan(fn(spark, SF), "simple")
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_order_fact_shuffles_at_scale(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        p = plan(E.queries()["fact_orders"](spark, SF), "simple")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    single = re.findall(r"Exchange hashpartitioning\((\w+)#\d+L?, \d+\)", p)
    # customer key: customers and the review window (their join reuses it); then one exchange of each side of the
    # salted join; order key: the fact once, plus the final step of each of the three line aggregates (the joins
    # reuse that partitioning, no extra exchange)
    assert single.count("customer_id") == 2
    assert len(re.findall(r"Exchange hashpartitioning\(customer_id#\d+L?, _salt#\d+", p)) == 2
    assert single.count("order_id") == 4
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 12


def test_indicators_read_orders_and_customers_once(spark):
    p = plan(E.queries()["kpi_by_place_year"](spark, SF))
    for table in ("orders", "customer"):
        scans = re.findall(rf"Location: InMemoryFileIndex \[file:[^]]*/{table}\.parquet.*?ReadSchema: (struct<.*?>)\n", p, re.S)
        assert len([s for s in scans if s != "struct<o_custkey:bigint>"]) == 1, table  # the heavy-key sketch reads the key alone


def test_quality_suite_scans(spark):
    p = plan(E.queries()["dq_suite"](spark, SF))
    assert len(re.findall(r"Location: InMemoryFileIndex \[file:[^]]*/lineitem\.parquet", p)) <= 5


def test_no_job_runs_while_a_panel_is_built(spark):
    spark.sparkContext.setJobGroup("building", "")
    try:
        spark.read.parquet(f"{SF}/nation.parquet").schema  # reading a footer is a job of its own
        before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("building"))
        catalog.queries()["monthly_panel"](spark, SF)
        tables = 4  # one footer job a table at most
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) - before <= tables
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_the_order_models_derive_the_staged_lines_once(spark):
    """Payments, items and their distinct counts read the written staging tables, not the lines again."""
    from peerscope.plans.model_queries import QUERIES

    for name in ("int_fact_orders", "mart_orders"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "l_orderkey" not in plan and "payment_type" in plan
