"""Structured Streaming forms: windowed aggregates, stateful processors, sinks."""

from tidemark.streaming.joins import stream_tx_interval_join
from tidemark.streaming.lateness import stream_split_late
from tidemark.streaming.processors import (
    stream_ad_click_filter,
    stream_ad_clicks_by_province,
    stream_login_fail_burst,
    stream_login_fail_immediate,
    stream_login_fail_pattern,
    stream_order_pay_match,
    stream_order_timeout,
    stream_tx_match,
    read_click_sink,
)
from tidemark.streaming.ranking import (
    current_ranking,
    stream_ranking_changes,
    stream_running_unique_visitors_exact,
)
from tidemark.streaming.sinks import (
    dead_letter_sink,
    foreach_batch,
    read_upserted,
    compact_upserted,
    rerank_each_batch,
    finish_sliding_counts,
    sliding_counts_each_batch,
    start_sink,
    top_n_each_batch,
    upsert_sink,
)
from tidemark.streaming.windows import (
    stream_hot_items_sql,
    stream_running_unique_visitors,
    stream_sliding_count,
    stream_top_n,
    stream_unique_visitors,
    stream_unique_visitors_bitmap,
    stream_unique_visitors_hll,
)

__all__ = [
    "current_ranking", "dead_letter_sink", "stream_ranking_changes", "stream_running_unique_visitors_exact",
    "compact_upserted", "finish_sliding_counts", "foreach_batch", "read_upserted", "sliding_counts_each_batch", "rerank_each_batch", "start_sink", "stream_hot_items_sql", "stream_ad_click_filter",
    "stream_ad_clicks_by_province", "read_click_sink",
    "stream_login_fail_burst", "stream_login_fail_immediate", "stream_login_fail_pattern",
    "stream_order_pay_match", "stream_order_timeout", "stream_running_unique_visitors",
    "stream_sliding_count", "stream_split_late", "stream_top_n", "stream_tx_interval_join", "stream_tx_match", "stream_unique_visitors",
    "stream_unique_visitors_bitmap", "stream_unique_visitors_hll", "top_n_each_batch", "upsert_sink",
]
