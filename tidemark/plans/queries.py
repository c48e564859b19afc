"""The registered queries: each reads the driver's tables under ``sf_dir``
and runs one operator with the parameters of ``params`` (FIXTURES.md).

==========================  ===================================================
key                         what it returns
==========================  ===================================================
windowed_count              views per item and 1 h / 5 min window
hot_items, hot_items_sql    top 5 items per window (DataFrame API / Spark SQL)
hot_items_summaries         the same by summaries of panes and exact counts of the surviving items
hot_pages                   top 3 URLs by GET per 10 min / 10 s window
page_views(_salted)         views per 1 h / 5 min window (plain / two-stage salted)
unique_visitors             distinct users (all events) per 1 h / 5 min window
unique_visitors_bitmap      distinct 2^29-bit offsets of the user id per hour
unique_visitors_hll         exact viewers per hour, and whether the HLL++ estimate is near
running_unique_visitors     distinct viewers so far in the hour, per view event
channel_counts              'error' events per channel, 1 day / 10 s windows
sliding_count_panes         the same from run-length rows
ad_click_filter / _warnings clicks passed (first per user, ad, UTC+8 day) / warned
ad_clicks_by_province       passed clicks per province, 1 day / 5 s windows
login_fail_pattern          fail then next fail < 6 h (first, second time, message)
login_fail_immediate        the same pairs, reported at the second fail
login_fail_burst            runs with >= 2 fails in 1 day and no success in it
order_timeout               each create: first later pay < 1 day, else timeout
order_pay_match             create/pay outcomes with a 1 day limit
tx_interval_join            pay/receipt pairs with receipt in [pay - 3 h, pay + 5 h]
tx_match                    pay taken by the next receipt within 3 days, or unmatched
split_late                  rows behind the watermark (delay 64 s, lateness 1 min)
==========================  ===================================================
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.time import floor_div
from tidemark.operators import fraud, lateness, matching, sequences, topn, visitors, windows
from tidemark.plans import params as P
from tidemark.sources import tables as T


def _ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.events(spark, sf_dir)


def windowed_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = T.page_views_input(_ev(spark, sf_dir), P.ITEM_MOD)
    return windows.sliding_count(views, ["item_id"], "ts", P.HOT_ITEMS_SIZE_S, P.HOT_ITEMS_SLIDE_S, method="expand")


def hot_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = T.page_views_input(_ev(spark, sf_dir), P.ITEM_MOD)
    return topn.hot_items(views, P.HOT_ITEMS_N, P.HOT_ITEMS_SIZE_S, P.HOT_ITEMS_SLIDE_S)


_HOT_ITEMS_SQL = """
WITH panes AS (  -- one row per item and {slide} s pane (partial aggregation map-side)
  SELECT item_id, (unix_micros(ts) - pmod(unix_micros(ts), {slide_us})) div {slide_us} AS pane, count(item_id) AS c
  FROM {view} WHERE behavior = 'pv'
  GROUP BY item_id, (unix_micros(ts) - pmod(unix_micros(ts), {slide_us})) div {slide_us}
), windows AS (  -- each pane total goes to the {ratio} windows that contain it
  SELECT item_id, (pane + m) * {slide_ms} AS window_end_ms, sum(c) AS cnt
  FROM panes LATERAL VIEW explode(sequence(1, {ratio})) s AS m
  GROUP BY item_id, (pane + m) * {slide_ms}
)
SELECT window_end_ms, item_id, cnt, rank_no FROM (
  SELECT window_end_ms, item_id, cnt,
         CAST(row_number() OVER (PARTITION BY window_end_ms ORDER BY cnt DESC, item_id) AS BIGINT) AS rank_no
  FROM windows
) WHERE rank_no <= {n}
"""


def hot_items_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SQL form: a temp view and Spark SQL text -- panes, their spread to
    windows, and ``row_number() <= n`` (planned as a partial WindowGroupLimit)."""
    view = "tidemark_user_behavior"
    # the view holds the view events only, so their predicate is pushed to the scan
    T.page_views_input(_ev(spark, sf_dir), P.ITEM_MOD).createOrReplaceTempView(view)
    slide_us = P.HOT_ITEMS_SLIDE_S * 1_000_000
    return spark.sql(_HOT_ITEMS_SQL.format(
        slide=P.HOT_ITEMS_SLIDE_S, slide_us=slide_us, slide_ms=P.HOT_ITEMS_SLIDE_S * 1000,
        ratio=P.HOT_ITEMS_SIZE_S // P.HOT_ITEMS_SLIDE_S, view=view, n=P.HOT_ITEMS_N))


def hot_items_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``hot_items`` from frequent-items summaries of the panes and an exact second pass."""
    views = T.page_views_input(_ev(spark, sf_dir), P.ITEM_MOD)
    return topn.sliding_top_n(views, "item_id", P.HOT_ITEMS_N, P.HOT_ITEMS_SIZE_S, P.HOT_ITEMS_SLIDE_S,
                              tracked=P.SUMMARY_ITEMS, kept=P.SUMMARY_KEPT)


def hot_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    # get_requests filters event_type, which reaches the scan; the operator's own filter on
    # the mapped ``method`` column alone would not
    return topn.hot_pages(T.get_requests(_ev(spark, sf_dir), P.URL_MOD), P.HOT_PAGES_N,
                          P.HOT_PAGES_SIZE_S, P.HOT_PAGES_SLIDE_S)


def page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = _ev(spark, sf_dir).filter(F.col("event_type") == "view")
    return visitors.page_views(views, "ts", P.PV_SIZE_S, P.PV_SLIDE_S)


def page_views_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = _ev(spark, sf_dir).filter(F.col("event_type") == "view")
    return visitors.page_views_salted(views, "ts", P.PV_SIZE_S, P.PV_SLIDE_S)


def unique_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visitors.unique_visitors(_ev(spark, sf_dir), "user_id", "ts", P.PV_SIZE_S, P.PV_SLIDE_S)


def _views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ev(spark, sf_dir).filter(F.col("event_type") == "view")


def unique_visitors_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visitors.unique_visitors_bitmap(_views(spark, sf_dir), "user_id", "ts", P.UV_TUMBLE_S,
                                           P.BITMAP_LOG2_BITS)


def unique_visitors_bitmap_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts read from the bitmap table."""
    return visitors.count_visitor_bitmaps(visitors.visitor_bitmaps(
        _views(spark, sf_dir), "user_id", "ts", P.UV_TUMBLE_S, P.BITMAP_LOG2_BITS))


def unique_visitors_bitmap_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts from the hourly bitmaps, or-ed together."""
    hours = visitors.visitor_bitmaps(_views(spark, sf_dir), "user_id", "ts", P.UV_TUMBLE_S, P.BITMAP_LOG2_BITS)
    return visitors.count_visitor_bitmaps(visitors.rollup_visitor_bitmaps(hours, P.UV_DAY_S))


def unique_visitors_hll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The estimate held against the exact count, window by window: ``within`` says whether it
    is as near as the sketch promises (at least one visitor's difference is allowed)."""
    views = _views(spark, sf_dir)
    estimate = visitors.unique_visitors_hll(views, "user_id", "ts", P.UV_TUMBLE_S, P.HLL_RSD)
    exact = (views.groupBy(windows.tumbling_end_ms("ts", P.UV_TUMBLE_S).alias("window_end_ms"))
             .agg(F.count_distinct("user_id").alias("exact_uv")))
    off = F.abs(F.col("uv") - F.col("exact_uv"))
    return exact.join(estimate, "window_end_ms").select(
        "window_end_ms", "exact_uv", (off <= F.greatest(F.lit(1.0), P.HLL_BOUND * F.col("exact_uv"))).alias("within"))


def running_unique_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visitors.running_unique_visitors(_views(spark, sf_dir), "user_id", "ts", "event_id",
                                            P.UV_TUMBLE_S)


def _market(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.market_behavior(_ev(spark, sf_dir), P.CHANNEL_MOD)


def channel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.channel_counts(_market(spark, sf_dir), P.CHANNEL_BEHAVIOR, P.CHANNEL_SIZE_S, P.CHANNEL_SLIDE_S)


def sliding_count_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``channel_counts`` as runs of windows with one count, spread to single windows."""
    errors = _market(spark, sf_dir).filter(F.col("behavior") == P.CHANNEL_BEHAVIOR)
    runs = windows.sliding_count_runs(errors, ["channel", "behavior"], "ts", P.CHANNEL_SIZE_S, P.CHANNEL_SLIDE_S)
    slide_ms = P.CHANNEL_SLIDE_S * 1000
    ends = F.sequence(F.col("end_from_ms"), F.col("end_to_ms") - slide_ms, F.lit(slide_ms).cast("bigint"))
    return runs.select("channel", "behavior", F.explode(ends).alias("window_end_ms"), "cnt").withColumn(
        "window_start_ms", F.col("window_end_ms") - P.CHANNEL_SIZE_S * 1000)


def _clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.ad_clicks(_ev(spark, sf_dir), P.AD_MOD, P.PROVINCE_MOD)


def ad_click_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    passed = fraud.ad_click_filter(_clicks(spark, sf_dir), P.AD_MAX_CLICKS,
                                   day_offset_s=P.AD_DAY_OFFSET_S)
    return passed.select("event_id", "user_id", "ad_id", "province",
                         floor_div(F.unix_micros("ts"), 1000).alias("ts_ms"))


def ad_click_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fraud.ad_click_warnings(_clicks(spark, sf_dir), P.AD_MAX_CLICKS,
                                   day_offset_s=P.AD_DAY_OFFSET_S)


def ad_clicks_by_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    passed = fraud.ad_click_filter(_clicks(spark, sf_dir), P.AD_MAX_CLICKS,
                                   day_offset_s=P.AD_DAY_OFFSET_S)
    return fraud.ad_clicks_by_province(passed, P.PROVINCE_SIZE_S, P.PROVINCE_SLIDE_S)


def _logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.logins(_ev(spark, sf_dir))


def login_fail_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.login_fail_pattern(_logins(spark, sf_dir), P.LOGIN_GAP_S)


def login_fail_pattern_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``login_fail_pattern`` where every user with over 20 logins is cut in chunks, as users with
    over a million are by default."""
    return sequences.login_fail_pattern(_logins(spark, sf_dir), P.LOGIN_GAP_S, chunk_rows=P.LOGIN_CUT_ROWS)


def login_fail_immediate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.login_fail_immediate(_logins(spark, sf_dir), P.LOGIN_GAP_S)


def login_fail_burst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.login_fail_burst(_logins(spark, sf_dir), P.BURST_MIN_FAILS, P.BURST_WINDOW_S)


def order_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.order_timeout(T.order_events(_ev(spark, sf_dir)), P.ORDER_TIMEOUT_S)


def order_pay_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.order_pay_match(T.order_events(_ev(spark, sf_dir)), P.ORDER_MATCH_S)


def tx_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _ev(spark, sf_dir)
    return matching.tx_interval_join(T.payments(ev), T.receipts(ev),
                                     P.TX_JOIN_BEFORE_S, P.TX_JOIN_AFTER_S).select(
        "tx_id", "pay_event_id", "receipt_event_id", "pay_ms", "receipt_ms",
        F.col("receipt.pay_channel").alias("pay_channel"))


def tx_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _ev(spark, sf_dir)
    matched = matching.tx_match(T.payments(ev), T.receipts(ev), P.TX_MATCH_WAIT_S)
    return matched.select("tx_id", "kind", "pay_event_id", "receipt_event_id", "pay_ms", "receipt_ms",
                          F.col("receipt.pay_channel").alias("pay_channel"))


def split_late(spark: SparkSession, sf_dir: str, chunk_rows: int | None = None) -> DataFrame:
    ev = T.with_arrival(_ev(spark, sf_dir)).select("event_id", "user_id", "ts", "arrival_us")
    tagged = lateness.split_late(ev, F.col("arrival_us"), "ts", "event_id", P.LATE_TUMBLE_S,
                                 None, P.LATE_DELAY_S, P.LATE_LATENESS_S, chunk_rows=chunk_rows)
    return (tagged.filter("is_late")
            .select("event_id", "user_id",
                    floor_div(F.unix_micros("ts"), 1000).alias("ts_ms"),
                    floor_div(F.col("arrival_us"), 1000).alias("arrival_ms"),
                    floor_div(F.col("last_window_end_us"), 1000).alias("window_end_ms"),
                    floor_div(F.col("watermark_us"), 1000).alias("watermark_ms")))


def split_late_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``split_late`` with arrival order cut in chunks of about 1,000 rows, as a large input is."""
    return split_late(spark, sf_dir, P.LATE_CUT_ROWS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "hot_items": hot_items,
    "hot_items_sql": hot_items_sql,
    "hot_items_summaries": hot_items_summaries,
    "hot_pages": hot_pages,
    "windowed_count": windowed_count,
    "page_views": page_views,
    "page_views_salted": page_views_salted,
    "unique_visitors": unique_visitors,
    "unique_visitors_bitmap": unique_visitors_bitmap,
    "unique_visitors_bitmap_stored": unique_visitors_bitmap_stored,
    "unique_visitors_bitmap_daily": unique_visitors_bitmap_daily,
    "unique_visitors_hll": unique_visitors_hll,
    "running_unique_visitors": running_unique_visitors,
    "channel_counts": channel_counts,
    "sliding_count_panes": sliding_count_panes,
    "ad_click_filter": ad_click_filter,
    "ad_click_warnings": ad_click_warnings,
    "ad_clicks_by_province": ad_clicks_by_province,
    "login_fail_pattern": login_fail_pattern,
    "login_fail_pattern_cut": login_fail_pattern_cut,
    "login_fail_burst": login_fail_burst,
    "login_fail_immediate": login_fail_immediate,
    "order_timeout": order_timeout,
    "order_pay_match": order_pay_match,
    "tx_interval_join": tx_interval_join,
    "tx_match": tx_match,
    "split_late": split_late,
    "split_late_cut": split_late_cut,
}
