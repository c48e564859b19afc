"""Physical-plan guards for every registered query (static plan, AQE off):
no cartesian or nested-loop joins, no sort-based or Python aggregation, filters
pushed to the parquet scan wherever the query selects event types, only the
needed columns read, and every input read once -- also when keys are cut in chunks."""

import re

import pytest

from tests.conftest import SF_SMALL
from tidemark.operators.scan import CHUNK_CONF
from tidemark.plans.queries import QUERIES

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "SortAggregate", "ObjectHashAggregate",
             "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"]
# queries over every event type have nothing to push down
NO_FILTER = {"unique_visitors", "split_late", "split_late_cut"}
# how often a query uses an input: two sides of a join, or two results held together
SCANS = {"tx_interval_join": 2, "tx_match": 2, "unique_visitors_hll": 2}
# bitmaps and sketches are objects: their aggregates are sorted, over a row a task and bucket or a task
OBJECTS = {"unique_visitors_bitmap_stored": ["SortAggregate"], "unique_visitors_bitmap_daily": ["SortAggregate"],
           "hot_items_summaries": ["SortAggregate", "ObjectHashAggregate"],
           "login_fail_pattern_cut": ["SortAggregate", "ObjectHashAggregate"]}
# the heavy keys of a cut scan are sketched, then counted; a cut scan without a key reads its totals
# (the summaries of panes, then the panes' counts)
EXTRA_SCANS = {"hot_items_summaries": 1, "login_fail_pattern_cut": 2, "split_late_cut": 1}
SCANNED = ["login_fail_pattern", "login_fail_immediate", "login_fail_burst", "order_timeout", "order_pay_match",
           "tx_match", "split_late"]


@pytest.fixture(scope="module")
def plans(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        yield {k: f(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
               for k, f in QUERIES.items()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(plans, name):
    plan = plans[name]
    assert not [op for op in FORBIDDEN if op in plan and op not in OBJECTS.get(name, [])], plan
    scans = re.findall(r"FileScan parquet [^\n]*", plan)
    assert scans
    for scan in scans:
        schema = re.search(r"ReadSchema: struct<([^>]*)>", scan).group(1)
        assert "props" not in schema or name in {"hot_items", "hot_items_sql", "hot_items_summaries", "hot_pages",
                                                  "windowed_count", "channel_counts",
                                                  "sliding_count_panes", "ad_click_filter",
                                                  "ad_click_warnings", "ad_clicks_by_province"}, schema
        if name not in NO_FILTER:
            assert re.search(r"PushedFilters: \[[^\]]*(EqualTo|In)\(event_type", scan), scan
    assert len(scans) <= SCANS.get(name, 1) + EXTRA_SCANS.get(name, 0), plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_nothing_runs_while_a_query_is_built(spark, name):
    """But for the schema of the table, read from one file a time it is named."""
    from tidemark.operators import scan

    sc = spark.sparkContext
    for small in (scan.SMALL_BYTES, 0):
        scan.SMALL_BYTES, old = small, scan.SMALL_BYTES
        try:
            sc.setJobGroup(f"build-{name}-{small}", "build")
            QUERIES[name](spark, SF_SMALL)
            assert len(sc.statusTracker().getJobIdsForGroup(f"build-{name}-{small}")) <= 1
        finally:
            scan.SMALL_BYTES = old
            sc.setJobGroup("", "")


@pytest.mark.parametrize("name", SCANNED)
def test_cut_keys_read_their_input_once(spark, name):
    """With every key over the limit the rows are still shuffled once: the chunk rows come from the
    same exchange.  The input is read for them once, and its keys for the sketch and the count."""
    from tests.conftest import rows

    expect = rows(QUERIES[name](spark, SF_SMALL))
    spark.conf.set(CHUNK_CONF, "3")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = QUERIES[name](spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(CHUNK_CONF)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    scans = len(re.findall(r"FileScan parquet .*events[.]parquet", plan))
    passes = 2 if name == "login_fail_burst" else 1      # two scans along the same order
    extra = 1 if name == "split_late" else 2
    assert scans <= SCANS.get(name, 1) * (passes + 1) * (1 + extra) and "ReusedExchange" in plan, plan
    assert rows(df) == expect
