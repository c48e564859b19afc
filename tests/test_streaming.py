"""Batch = stream: each streaming form, fed the driver's rows as a file stream
in event order (one file per micro-batch) plus a far-future sentinel row that
flushes every window and timer, gives the rows of its batch twin."""

import datetime as dt
import itertools
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from tests.conftest import SF_SMALL, rows
from tidemark import operators as O
from tidemark import streaming as S
from tidemark.sources import tables as T

FAR = dt.datetime(2100, 1, 1, tzinfo=dt.timezone.utc)
_ids = itertools.count()
MATCH = ["tx_id", "kind", "pay_event_id", "receipt_event_id", "pay_ms", "receipt_ms"]


def as_stream(spark, df, key_cols, n_files=6, arrival=None, sentinels=1):
    """Write ``df`` as ``n_files`` parquet files + a sentinel; read as a stream.

    Files are cut in event-time order, or in ``arrival`` order (a column
    expression) to feed rows out of order."""
    path = tempfile.mkdtemp(prefix="tidemark-stream-")
    order = [arrival, F.col("event_id")] if arrival is not None else ["ts", "event_id"]
    tiles = df.withColumn("__t", F.ntile(n_files).over(Window.orderBy(*order)))
    for i in range(1, n_files + 1):
        tiles.filter(F.col("__t") == i).drop("__t").coalesce(1).write.mode("append").parquet(path)
    sentinel = df.limit(1).withColumn("ts", F.lit(FAR).cast("timestamp")).withColumn("event_id", F.lit(-1).cast("long"))
    for k in key_cols:
        sentinel = sentinel.withColumn(k, F.lit(-1).cast(df.schema[k].dataType))
    for i in range(sentinels):
        sentinel.withColumn("ts", F.col("ts") + F.make_dt_interval(F.lit(400 * i))).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def run_stream(out, output_mode="append"):
    name = f"tidemark_t{next(_ids)}"
    # availableNow runs every file as its own batch, then the no-data batch
    # that moves the watermark past the sentinel and flushes state
    q = out.writeStream.queryName(name).outputMode(output_mode).format("memory") \
        .option("checkpointLocation", tempfile.mkdtemp(prefix="tidemark-ckpt-")) \
        .trigger(availableNow=True).start()
    try:
        q.awaitTermination(300)
    finally:
        q.stop()
    return out.sparkSession.table(name)


@pytest.fixture(scope="module")
def ev(spark):
    return T.events(spark, SF_SMALL).cache()


def _no_sentinel(df, col):
    return df.filter(F.col(col) != -1)


def test_login_fail_pattern_stream(spark, ev):
    logins = T.logins(ev)
    got = run_stream(S.stream_login_fail_pattern(as_stream(spark, logins, ["user_id"]), 6 * 3600, 0))
    assert rows(_no_sentinel(got, "user_id")) == rows(O.login_fail_pattern(logins, 6 * 3600))


def test_login_fail_immediate_and_burst_stream(spark, ev):
    logins = T.logins(ev)
    got = run_stream(S.stream_login_fail_immediate(as_stream(spark, logins, ["user_id"]), 6 * 3600, 0))
    assert rows(_no_sentinel(got, "user_id")) == rows(O.login_fail_immediate(logins, 6 * 3600))
    got = run_stream(S.stream_login_fail_burst(as_stream(spark, logins, ["user_id"]), 2, 86400, 0))
    assert rows(_no_sentinel(got, "user_id")) == rows(O.login_fail_burst(logins, 2, 86400))


def test_order_streams(spark, ev):
    orders = T.order_events(ev)
    got = run_stream(S.stream_order_pay_match(as_stream(spark, orders, ["order_id"]), 86400))
    assert rows(_no_sentinel(got, "order_id")) == rows(O.order_pay_match(orders, 86400))
    got = run_stream(S.stream_order_timeout(as_stream(spark, orders, ["order_id"]), 86400))
    assert rows(_no_sentinel(got, "order_id")) == rows(O.order_timeout(orders, 86400))


def test_ad_click_stream(spark, ev):
    clicks = T.ad_clicks(ev)
    got = _no_sentinel(run_stream(S.stream_ad_click_filter(as_stream(spark, clicks, ["user_id"]), 2)),
                       "user_id")
    passed = O.ad_click_filter(clicks, 2).select("event_id")
    assert rows(got.filter("kind = 'pass'").select("event_id")) == rows(passed)
    warn = O.ad_click_warnings(clicks, 2)
    assert rows(got.filter("kind = 'warning'").select("user_id", "ad_id", "day_start_ms", "event_id",
                                                       "ts_ms")) == rows(warn)


def test_tx_match_stream(spark, ev):
    pays, recs = T.payments(ev), T.receipts(ev)
    out = S.stream_tx_match(as_stream(spark, pays, ["tx_id"]),
                            as_stream(spark, recs.select("event_id", "tx_id", "ts"), ["tx_id"]), 3 * 86400)
    got = _no_sentinel(run_stream(out), "tx_id")
    assert rows(got, MATCH) == rows(O.tx_match(pays, recs, 3 * 86400), MATCH)
    assert {r.pay.event for r in got.filter("pay IS NOT NULL").collect()} == {"pay"}
    assert all(r.receipt.event_id == r.receipt_event_id for r in got.filter("receipt IS NOT NULL").collect())


def test_hot_items_stream(spark, ev):
    views = T.page_views_input(ev)
    # the sentinel's rows are removed after the stream: a filter on the key
    # would be pushed below the watermark and drop the sentinel too early
    counts = S.stream_sliding_count(as_stream(spark, views, ["item_id"]), ["item_id"], "ts", 3600, 300)
    got = _no_sentinel(run_stream(counts), "item_id")
    batch = O.sliding_count(views, ["item_id"], "ts", 3600, 300)
    assert rows(got.drop("window")) == rows(batch)
    top = run_stream(S.stream_top_n(
        S.stream_sliding_count(as_stream(spark, views, ["item_id"]), ["item_id"], "ts", 3600, 300),
        "item_id", 5))
    top = top.filter(F.col("window_end_ms") < F.unix_millis(F.lit(FAR).cast("timestamp")))
    cols = ["window_end_ms", "item_id", "cnt", "rank_no"]
    assert rows(top, cols) == rows(O.top_n(batch, "window_end_ms", "item_id", 5), cols)


def test_unique_visitors_stream(spark, ev):
    got = run_stream(S.stream_unique_visitors(as_stream(spark, ev, ["user_id"]),
                                              "user_id", "ts", 3600, 300))
    got = got.filter(F.col("window_end_ms") < F.unix_millis(F.lit(FAR).cast("timestamp")))
    assert rows(got) == rows(O.unique_visitors(ev, "user_id", "ts", 3600, 300))


def test_tx_interval_join_stream(spark, ev):
    pays, recs = T.payments(ev), T.receipts(ev)
    out = S.stream_tx_interval_join(as_stream(spark, pays, ["tx_id"]),
                                    as_stream(spark, recs.select("event_id", "tx_id", "ts"), ["tx_id"]),
                                    3 * 3600, 5 * 3600)
    got = _no_sentinel(run_stream(out), "tx_id")
    cols = ["tx_id", "pay_event_id", "receipt_event_id", "pay_ms", "receipt_ms"]
    assert rows(got, cols) == rows(O.tx_interval_join(pays, recs, 3 * 3600, 5 * 3600), cols)


def test_split_late_stream_tags_against_batch_watermark(spark, ev):
    """Files cut in arrival order; the watermark of batch i is the max event time of files
    < i minus the delay (ms), so the tags can be recomputed.  Both outputs keep the whole rows."""
    n_files, delay_s, lateness_s, size_s = 12, 64, 60, 3600
    arr = T.with_arrival(ev).withColumn("__t", F.ntile(n_files).over(Window.orderBy("arrival_us", "event_id")))
    path, out = tempfile.mkdtemp(prefix="tidemark-late-"), tempfile.mkdtemp(prefix="tidemark-split-")
    for i in range(1, n_files + 1):
        arr.filter(F.col("__t") == i).select(*ev.columns).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(path)
    ck = tempfile.mkdtemp()
    q = S.stream_split_late(stream, out, f"tidemark_t{next(_ids)}", size_s, None, delay_s, lateness_s, checkpoint=ck,
                            trigger={"availableNow": True})
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    assert set(ev.columns) <= set(got.columns)
    assert rows(got.select("event_id", "user_id", "event_type", "value")) == rows(ev.select("event_id", "user_id", "event_type", "value"))
    maxes = {r["__t"]: r["m"] for r in arr.groupBy("__t").agg(F.max(F.floor(F.unix_micros("ts") / 1000)).alias("m")).collect()}
    wm, running = {}, None
    for i in range(1, n_files + 1):
        wm[i] = (running - delay_s * 1000) if running is not None else None
        running = maxes[i] if running is None else max(running, maxes[i])
    tiles = {r["event_id"]: r["__t"] for r in arr.select("event_id", "__t").collect()}
    n_late = 0
    for r in got.collect():
        w = wm[tiles[r["event_id"]]]
        assert r["watermark_ms"] == w
        assert r["is_late"] == (w is not None and r["window_end_ms"] + lateness_s * 1000 <= w), r
        n_late += r["is_late"]
    assert n_late > 0


def test_out_of_order_within_delay(spark, ev):
    """Rows fed in arrival order (ts + value minutes, up to ~8 h late) with a
    9 h watermark delay: the processors still give the batch rows."""
    late_by = F.unix_micros("ts") + F.round(F.col("value") * 60_000_000).cast("bigint")
    assert ev.select(F.max("value")).first()[0] < 9 * 60
    ids = ev.select("event_id", late_by.alias("__arr"))
    logins = T.logins(ev).join(ids, "event_id")
    got = run_stream(S.stream_login_fail_pattern(
        as_stream(spark, logins, ["user_id"], 12, F.col("__arr")).drop("__arr"), 6 * 3600, 9 * 3600))
    assert rows(_no_sentinel(got, "user_id")) == rows(O.login_fail_pattern(T.logins(ev), 6 * 3600))
    orders = T.order_events(ev).join(ids, "event_id")
    got = run_stream(S.stream_order_pay_match(
        as_stream(spark, orders, ["order_id"], 12, F.col("__arr")).drop("__arr"), 86400, 9 * 3600))
    assert rows(_no_sentinel(got, "order_id")) == rows(O.order_pay_match(T.order_events(ev), 86400))


@pytest.mark.parametrize("late", [False, True])
def test_long_windows_from_panes_each_batch(spark, ev, late):
    """1 day every minute, and every batch replayed once more: the same rows."""
    market = T.market_behavior(ev).filter("behavior = 'error'").withColumn("k", F.col("channel").cast("long"))
    src = market.select("event_id", "k", "ts")
    late_by = F.unix_micros("ts") + F.round(F.col("value") * 60_000_000).cast("bigint")
    if late:
        src = src.join(ev.select("event_id", late_by.alias("__arr")), "event_id")
        stream = as_stream(spark, src, ["k"], 12, F.col("__arr"), sentinels=2).drop("__arr")
    else:
        stream = as_stream(spark, src, ["k"], sentinels=2)
    panes, out = tempfile.mkdtemp(prefix="tidemark-panes-"), tempfile.mkdtemp(prefix="tidemark-long-")
    q = S.sliding_counts_each_batch(stream, ["k"], 86400, 60, panes, out, f"tidemark_t{next(_ids)}",
                                    delay_s=9 * 3600 if late else 0, checkpoint=tempfile.mkdtemp(), trigger={"availableNow": True})
    q.awaitTermination(300)
    got = _no_sentinel(spark.read.parquet(out), "k")
    assert rows(got.select("k", "window_end_ms", "cnt")) == rows(O.sliding_count(market, ["k"], "ts", 86400, 60))


def test_hll_and_running_uv_streams(spark, ev):
    views = ev.filter("event_type = 'view'")
    far = F.unix_millis(F.lit(FAR).cast("timestamp"))
    got = run_stream(S.stream_unique_visitors_hll(as_stream(spark, views, ["user_id"]), "user_id", "ts", 3600))
    got = got.filter(F.col("window_end_ms") < far)
    assert rows(got) == rows(O.unique_visitors_hll(views, "user_id", "ts", 3600))
    bits = run_stream(S.stream_unique_visitors_bitmap(as_stream(spark, views, ["user_id"]), log2_bits=6))
    bits = bits.filter(F.col("window_end_ms") < far)
    assert rows(bits) == rows(O.unique_visitors_bitmap(views, "user_id", "ts", 3600, 6))
    # update mode: the last update of each window is its final estimate
    upd = run_stream(S.stream_running_unique_visitors(as_stream(spark, views, ["user_id"]), "user_id", "ts", 3600),
                     output_mode="update")
    final = (upd.select(F.unix_millis("window.end").alias("window_end_ms"), "uv")
             .filter(F.col("window_end_ms") < far).groupBy("window_end_ms").agg(F.max("uv").alias("uv")))
    assert rows(final) == rows(O.unique_visitors_hll(views, "user_id", "ts", 3600))
    assert upd.count() >= final.count()


def test_update_mode_refires_end_at_batch_counts(spark, ev):
    """Update mode with rows out of order: windows are re-emitted as late rows
    correct them; the last emission of each window equals the batch count."""
    views = T.page_views_input(ev)
    late_by = F.unix_micros("ts") + F.round(F.col("value") * 60_000_000).cast("bigint")
    src = views.join(ev.select("event_id", late_by.alias("__arr")), "event_id")
    stream = as_stream(spark, src, ["item_id"], 12, F.col("__arr")).drop("__arr")
    out = S.stream_sliding_count(stream, [], "ts", 3600, 300, delay_s=9 * 3600, method="native")
    upd = run_stream(out, output_mode="update").filter(
        F.col("window_end_ms") < F.unix_millis(F.lit(FAR).cast("timestamp")))
    last = upd.groupBy("window_end_ms").agg(F.max("cnt").alias("cnt"))
    assert upd.count() > last.count()   # some windows were emitted more than once
    assert rows(last) == rows(O.sliding_count(views, [], "ts", 3600, 300))


def test_ad_clicks_by_province_two_stage_stream(spark, ev):
    clicks = T.ad_clicks(ev)
    sink = tempfile.mkdtemp(prefix="tidemark-pass-")
    first = S.start_sink(S.stream_ad_click_filter(as_stream(spark, clicks, ["user_id"]), 2),
                         f"tidemark_t{next(_ids)}", fmt="parquet", path=sink,
                         checkpoint=tempfile.mkdtemp(), trigger={"availableNow": True})
    first.awaitTermination(300)
    # the second query gets its own far-future row to flush its last windows
    flush = tempfile.mkdtemp(prefix="tidemark-flush-")
    # (and one behind it, so that the windows up to it are final)
    spark.createDataFrame([(-1, -1, "pass", -1, "-1", int(FAR.timestamp() * 1000) + d * 400 * 86_400_000, 0) for d in (0, 1)],
                          S.read_click_sink(spark, sink).drop("ts").schema).write.mode("append").parquet(flush)
    passed_stream = S.read_click_sink(spark, sink).unionByName(S.read_click_sink(spark, flush))
    counts = tempfile.mkdtemp(prefix="tidemark-prov-")
    q = S.stream_ad_clicks_by_province(passed_stream, tempfile.mkdtemp(), counts, f"tidemark_t{next(_ids)}", 86400, 3600,
                                       checkpoint=tempfile.mkdtemp(), trigger={"availableNow": True})
    q.awaitTermination(300)
    got = spark.read.parquet(counts).filter("province != '-1'").select("province", "window_end_ms", "cnt")
    passed = O.ad_click_filter(clicks, 2)
    assert rows(got) == rows(O.ad_clicks_by_province(passed, 86400, 3600))


def test_top_n_each_batch(spark, ev):
    views = T.page_views_input(ev)
    counts = S.stream_sliding_count(as_stream(spark, views, ["item_id"]), ["item_id"], "ts", 3600, 300)
    out = tempfile.mkdtemp(prefix="tidemark-topn-")
    q = S.top_n_each_batch(counts, "item_id", 5, out, f"tidemark_t{next(_ids)}",
                           checkpoint=tempfile.mkdtemp(), trigger={"availableNow": True})
    q.awaitTermination(300)
    got = spark.read.parquet(out).drop("batch_id").filter("item_id != -1")
    batch = O.top_n(O.sliding_count(views, ["item_id"], "ts", 3600, 300), "window_end_ms", "item_id", 5)
    cols = ["window_end_ms", "item_id", "cnt", "rank_no"]
    assert rows(got, cols) == rows(batch, cols)


def test_hot_items_sql_stream(spark, ev):
    # view rows only: the SQL filter is pushed below the watermark, and the
    # flushing sentinel must pass it to move the watermark
    ub = T.page_views_input(ev)
    got = run_stream(S.stream_hot_items_sql(as_stream(spark, ub, ["item_id"])))
    got = got.filter(F.col("window_end_ms") < F.unix_millis(F.lit(FAR).cast("timestamp")))
    assert rows(got) == rows(O.hot_items(ub))


def test_rerank_on_late_updates(spark, ev):
    """Hot pages with rows out of order: rankings are re-emitted as late rows
    change a window; the newest version of each window is the batch ranking."""
    gets = T.get_requests(ev)
    late_by = F.unix_micros("ts") + F.round(F.col("value") * 60_000_000).cast("bigint")
    src = gets.join(ev.select("event_id", late_by.alias("__arr")), "event_id")
    stream = as_stream(spark, src, [], 12, F.col("__arr")).drop("__arr")
    counts = S.stream_sliding_count(stream, ["url"], "ts", 7200, 600, delay_s=9 * 3600, method="native")
    out = tempfile.mkdtemp(prefix="tidemark-rank-")
    q = S.rerank_each_batch(counts, "url", 3, tempfile.mkdtemp(prefix="tidemark-cnt-"), out,
                            f"tidemark_t{next(_ids)}", checkpoint=tempfile.mkdtemp(),
                            trigger={"availableNow": True})
    q.awaitTermination(600)
    ranks = spark.read.parquet(out).filter(F.col("window_end_ms") < F.unix_millis(F.lit(FAR).cast("timestamp")))
    newest = ranks.withColumn("__v", F.max("version").over(Window.partitionBy("window_end_ms"))) \
        .filter("version = __v").drop("__v", "version")
    assert ranks.select("window_end_ms", "version").distinct().count() > newest.select("window_end_ms").distinct().count()
    batch = O.hot_pages(T.access_log(ev), 3, 7200, 600)
    cols = ["window_end_ms", "url", "cnt", "rank_no"]
    assert rows(newest, cols) == rows(batch, cols)


def test_rerank_of_a_replayed_batch_changes_nothing(spark, monkeypatch):
    """The batch function is run twice for one batch, as after a failure between its writes."""
    from tidemark.streaming import sinks

    caught = []
    monkeypatch.setattr(sinks, "foreach_batch", lambda df, fn, *a, **k: caught.append(fn))
    counts, out = tempfile.mkdtemp(prefix="tidemark-cnt-"), tempfile.mkdtemp(prefix="tidemark-rank-")
    sinks.rerank_each_batch(None, "url", 1, counts, out, "x")
    batches = [[(10, "a", 1), (10, "b", 2), (20, "a", 9)], [(10, "a", 5)]]
    for i, batch in enumerate(batches):
        frame = spark.createDataFrame(batch, "window_end_ms long, url string, cnt long")
        for _ in range(2):
            caught[0](frame, i)
    got = rows(spark.read.parquet(out), ["version", "window_end_ms", "url", "cnt"])
    assert got == [(0, 10, "b", 2), (0, 20, "a", 9), (1, 10, "a", 5)]


def test_out_of_order_other_processors(spark, ev):
    late_by = F.unix_micros("ts") + F.round(F.col("value") * 60_000_000).cast("bigint")
    ids = ev.select("event_id", late_by.alias("__arr"))
    d = 9 * 3600

    def shuffled(df, keys):
        return as_stream(spark, df.join(ids, "event_id"), keys, 12, F.col("__arr")).drop("__arr")

    logins = T.logins(ev)
    got = run_stream(S.stream_login_fail_burst(shuffled(logins, ["user_id"]), 2, 86400, d))
    assert rows(_no_sentinel(got, "user_id")) == rows(O.login_fail_burst(logins, 2, 86400))
    orders = T.order_events(ev)
    got = run_stream(S.stream_order_timeout(shuffled(orders, ["order_id"]), 86400, d))
    assert rows(_no_sentinel(got, "order_id")) == rows(O.order_timeout(orders, 86400))
    clicks = T.ad_clicks(ev)
    got = _no_sentinel(run_stream(S.stream_ad_click_filter(shuffled(clicks, ["user_id"]), 2, delay_s=d)),
                       "user_id")
    assert rows(got.filter("kind = 'pass'").select("event_id")) == rows(O.ad_click_filter(clicks, 2).select("event_id"))
    pays, recs = T.payments(ev), T.receipts(ev)
    out = S.stream_tx_match(shuffled(pays, ["tx_id"]), shuffled(recs.select("event_id", "tx_id", "ts"), ["tx_id"]),
                            3 * 86400, d)
    assert rows(_no_sentinel(run_stream(out), "tx_id"), MATCH) == rows(O.tx_match(pays, recs, 3 * 86400), MATCH)


def test_chained_window_counts_out_of_order(spark, ev):
    """Append-mode pane chain with rows up to 8 h late and delay + lateness
    covering it: each window is emitted once, with its batch count."""
    gets = T.get_requests(ev)
    late_by = F.unix_micros("ts") + F.round(F.col("value") * 60_000_000).cast("bigint")
    src = gets.join(ev.select("event_id", late_by.alias("__arr")), "event_id")
    stream = as_stream(spark, src, [], 12, F.col("__arr")).drop("__arr")
    out = S.stream_sliding_count(stream, ["url"], "ts", 7200, 600, delay_s=8 * 3600 + 1800,
                                 lateness_s=1800, method="chain")
    got = run_stream(out).filter(F.col("window_end_ms") < F.unix_millis(F.lit(FAR).cast("timestamp")))
    assert got.count() == got.select("url", "window_end_ms").distinct().count()
    assert rows(got.drop("window")) == rows(O.sliding_count(gets, ["url"], "ts", 7200, 600))
