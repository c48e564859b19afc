"""Batch operators: each is a function from DataFrame to DataFrame."""

from tidemark.operators.fraud import (
    ad_click_filter,
    ad_click_warnings,
    ad_clicks_by_province,
    rank_daily_clicks,
)
from tidemark.operators.lateness import split_late
from tidemark.operators.matching import tx_interval_join, tx_match
from tidemark.operators.scan import ScanAgg, segmented_scan
from tidemark.operators.sequences import (
    login_fail_burst,
    login_fail_immediate,
    login_fail_pattern,
    order_pay_match,
    order_timeout,
)
from tidemark.operators.topn import format_top_n_report, hot_items, hot_pages, sliding_top_n, top_n
from tidemark.operators.visitors import (
    count_visitor_bitmaps,
    merge_visitor_bitmaps,
    page_views,
    page_views_salted,
    rollup_visitor_bitmaps,
    rollup_visitor_sketches,
    running_unique_visitors,
    unique_visitors,
    unique_visitors_bitmap,
    unique_visitors_hll,
    unique_visitors_sketch,
    visitor_bitmaps,
    visitor_bits,
)
from tidemark.operators.windows import (
    channel_counts,
    pane_counts,
    sliding_count,
    sliding_count_runs,
    sliding_distinct_count,
)

__all__ = [
    "ScanAgg", "count_visitor_bitmaps", "merge_visitor_bitmaps", "rollup_visitor_bitmaps", "visitor_bitmaps",
    "visitor_bits", "ad_click_filter", "channel_counts", "hot_items", "hot_pages", "sliding_top_n", "ad_click_warnings", "ad_clicks_by_province",
    "format_top_n_report", "login_fail_burst", "login_fail_immediate", "login_fail_pattern",
    "order_pay_match", "order_timeout", "page_views", "page_views_salted", "pane_counts",
    "rank_daily_clicks", "rollup_visitor_sketches", "running_unique_visitors", "segmented_scan", "sliding_count",
    "sliding_count_runs", "sliding_distinct_count", "split_late", "top_n", "tx_interval_join",
    "tx_match", "unique_visitors", "unique_visitors_bitmap", "unique_visitors_hll",
    "unique_visitors_sketch",
]
