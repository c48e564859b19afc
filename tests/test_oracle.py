"""Every registered query equals its DuckDB twin on the smallest driver tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SF_SMALL
from tidemark.plans.oracle import ORACLE_SQL as ORACLE
from tidemark.plans.queries import QUERIES


@pytest.fixture(scope="module")
def results(spark):
    from tools.check_oracle import compare

    return compare(spark, SF_SMALL, list(QUERIES))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(results, name):
    res = results[name]
    assert res["spark_rows"] > 0
    assert res["cols_equal"], res
    assert res["spark_rows"] == res["oracle_rows"]
    assert res["rows_equal"], res


def test_every_query_has_an_oracle_and_is_registered():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["window_end_ms", "item_id", "cnt", "rank_no"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["hot_items", "hot_items_sql", "ad_click_warnings", "order_pay_match",
                                  "split_late", "login_fail_burst"])
def test_results_do_not_depend_on_session_time_zone(spark, name):
    from tests.conftest import rows

    base = rows(QUERIES[name](spark, SF_SMALL))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        other = rows(QUERIES[name](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert other == base


def test_sketch_close_to_exact(spark):
    from pyspark.sql import functions as F

    from tidemark.operators import unique_visitors_sketch
    from tidemark.sources import tables as T

    views = T.events(spark, SF_SMALL).filter("event_type = 'view'")
    est = unique_visitors_sketch(views).select("window_end_ms", F.col("uv").alias("est"))
    exact = QUERIES["unique_visitors_bitmap"](spark, SF_SMALL)
    worst = est.join(exact, "window_end_ms").select(
        F.max(F.abs(F.col("est") - F.col("uv")) / F.col("uv"))).first()[0]
    assert worst <= 0.05


def test_sketch_rollup_equals_direct(spark):
    from tests.conftest import rows
    from tidemark.operators import rollup_visitor_sketches, unique_visitors_sketch
    from tidemark.sources import tables as T

    views = T.events(spark, SF_SMALL).filter("event_type = 'view'")
    hourly = unique_visitors_sketch(views, window_s=3600)
    daily = rollup_visitor_sketches(hourly, 86400).select("window_end_ms", "uv")
    direct = unique_visitors_sketch(views, window_s=86400).select("window_end_ms", "uv")
    assert rows(daily) == rows(direct)
