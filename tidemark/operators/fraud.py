"""Click-fraud filter: per (user, ad) and local calendar day, pass the first N
clicks, raise one warning at click N+1, drop the rest; count the passed clicks
per province over long sliding windows.

The original keys a counter by (user, ad) and resets it at local midnight
(UTC+8).  As a batch plan this is ``row_number()`` over (user, ad, local day)
in ``(ts, id)`` order.  Only ranks up to N+1 are ever needed, so the filter on
the rank lets Catalyst insert a partial ``WindowGroupLimit`` before the
shuffle: a user who clicks millions of times sends at most N+1 rows per map
task, and the hot group never reaches one task whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.constants import LOCAL_DAY_OFFSET_S
from tidemark.functions.time import DAY_S, floor_div, local_day
from tidemark.operators.windows import sliding_count


def rank_daily_clicks(clicks: DataFrame, max_clicks: int = 100, user: str = "user_id",
                      ad: str = "ad_id", ts: str = "ts", order_id: str = "event_id",
                      day_offset_s: int = LOCAL_DAY_OFFSET_S) -> DataFrame:
    """Clicks with ``click_rank`` (1-based within user, ad, local day) up to
    ``max_clicks + 1`` and ``local_day`` (day index); later clicks are dropped."""
    day = local_day(F.unix_micros(ts), day_offset_s)
    w = Window.partitionBy(user, ad, "local_day").orderBy(F.col(ts), F.col(order_id))
    return (clicks.withColumn("local_day", day)
            .withColumn("click_rank", F.row_number().over(w))
            .filter(F.col("click_rank") <= max_clicks + 1))


def ad_click_filter(clicks: DataFrame, max_clicks: int = 100, **kw) -> DataFrame:
    """The clicks that pass (the first ``max_clicks`` per user, ad and day)."""
    ranked = rank_daily_clicks(clicks, max_clicks, **kw)
    return ranked.filter(F.col("click_rank") <= max_clicks).drop("click_rank", "local_day")


def ad_click_warnings(clicks: DataFrame, max_clicks: int = 100, user: str = "user_id",
                      ad: str = "ad_id", ts: str = "ts", order_id: str = "event_id",
                      day_offset_s: int = LOCAL_DAY_OFFSET_S) -> DataFrame:
    """One warning per (user, ad, day) that goes over the limit, at the first
    click over it: ``user_id, ad_id, day_start_ms, event_id, ts_ms``."""
    ranked = rank_daily_clicks(clicks, max_clicks, user, ad, ts, order_id, day_offset_s)
    day_ms, off_ms = DAY_S * 1000, day_offset_s * 1000
    return (ranked.filter(F.col("click_rank") == max_clicks + 1)
            .select(user, ad,
                    (F.col("local_day") * F.lit(day_ms) - F.lit(off_ms)).cast("bigint").alias("day_start_ms"),
                    order_id, floor_div(F.unix_micros(ts), 1000).alias("ts_ms")))


def ad_clicks_by_province(passed: DataFrame, size_s: float = 86400, slide_s: float = 5,
                          province: str = "province", ts: str = "ts") -> DataFrame:
    """Passed clicks per province and sliding window: ``province, window_end_ms, cnt``.

    The original 1 day / 5 s window puts each click in 17,280 windows; the pane
    method counts each click once and spreads only pane totals.
    """
    return sliding_count(passed, [province], ts, size_s, slide_s)
