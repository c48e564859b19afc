"""Pane methods equal Spark's native sliding window on random inputs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import sliding_count, sliding_count_runs, sliding_distinct_count


def _events(spark, n, seed, keys=3, span_s=5 * 86400):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    data = [(i, rnd.randrange(keys), rnd.randrange(7),
             base + dt.timedelta(microseconds=rnd.randrange(span_s * 1_000_000)))
            for i in range(n)]
    return spark.createDataFrame(data, "event_id long, k long, user_id long, ts timestamp")


@pytest.mark.parametrize("size_s,slide_s,seed", [
    (3600, 300, 1), (7200, 600, 2), (86400, 3600, 3), (600, 10, 4), (3600, 3600, 5), (90, 30, 6)])
def test_expand_and_delta_equal_native(spark, size_s, slide_s, seed):
    ev = _events(spark, 400, seed)
    native = rows(sliding_count(ev, ["k"], "ts", size_s, slide_s, method="native", with_start=True))
    for method in ("expand", "delta"):
        got = rows(sliding_count(ev, ["k"], "ts", size_s, slide_s, method=method, with_start=True))
        assert got == native, method


def test_runs_expand_to_dense(spark):
    ev = _events(spark, 120, 9)
    size_s, slide_s = 86400, 300
    runs = sliding_count_runs(ev, ["k"], "ts", size_s, slide_s)
    dense = runs.select("k", F.explode(F.sequence("end_from_ms", F.col("end_to_ms") - 300000,
                                                  F.lit(300000).cast("bigint"))).alias("window_end_ms"),
                        "cnt")
    native = sliding_count(ev, ["k"], "ts", size_s, slide_s, method="native")
    assert rows(dense) == rows(native.select("k", "window_end_ms", "cnt"))
    # run-length form is much smaller than the dense one
    assert runs.count() * 20 < native.count()


def test_no_key_delta(spark):
    ev = _events(spark, 200, 11)
    a = rows(sliding_count(ev, [], "ts", 3600, 60, method="delta"))
    b = rows(sliding_count(ev, [], "ts", 3600, 60, method="native"))
    assert a == b


def test_distinct_count_equals_native(spark):
    ev = _events(spark, 300, 12)
    got = rows(sliding_distinct_count(ev, ["k"], "user_id", "ts", 3600, 900))
    w = F.window("ts", "3600 seconds", "900 seconds")
    native = (ev.groupBy("k", w.alias("w")).agg(F.count_distinct("user_id").alias("uv"))
              .select("k", F.unix_millis("w.end").alias("window_end_ms"), "uv"))
    assert got == rows(native)


def test_size_must_be_multiple_of_slide(spark):
    ev = _events(spark, 10, 1)
    with pytest.raises(ValueError):
        sliding_count(ev, [], "ts", 100, 30)


def test_original_defaults_entry_points(spark):
    from tidemark.operators import channel_counts, hot_items, hot_pages
    from tidemark.sources import tables as T

    ev = T.events(spark, "/root/testdata/sf0.001")
    top = hot_items(T.user_behavior(ev))
    assert top.columns == ["window_end_ms", "item_id", "cnt", "rank_no"]
    assert top.groupBy("window_end_ms").count().agg(F.max("count")).first()[0] <= 5
    pages = hot_pages(T.access_log(ev))
    assert pages.groupBy("window_end_ms").count().agg(F.max("count")).first()[0] <= 3
    # 1 day every 10 s goes through the delta method; equal to spreading every
    # pane to its 8,640 windows (native window() is checked at small ratios above)
    market = T.market_behavior(ev)
    a = rows(channel_counts(market, "error"))
    spread = sliding_count(market.filter("behavior = 'error'"), ["channel", "behavior"], "ts",
                           86400, 10, method="expand", with_start=True)
    assert a == rows(spread)


@pytest.mark.parametrize("size_s,slide_s,seed", [(3600, 300, 21), (7200, 60, 22), (600, 600, 23)])
def test_distinct_delta_equals_expand(spark, size_s, slide_s, seed):
    ev = _events(spark, 400, seed, span_s=2 * 86400)
    a = rows(sliding_distinct_count(ev, ["k"], "user_id", "ts", size_s, slide_s, method="delta"))
    b = rows(sliding_distinct_count(ev, ["k"], "user_id", "ts", size_s, slide_s, method="expand"))
    assert a == b
    c = rows(sliding_distinct_count(ev, [], "user_id", "ts", size_s, slide_s, method="delta"))
    d = rows(sliding_distinct_count(ev, [], "user_id", "ts", size_s, slide_s, method="expand"))
    assert c == d
