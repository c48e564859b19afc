"""Streaming forms of the window operators (watermark + append mode).

Append mode emits each window once, when the watermark passes its end, with
the final count (the original's allowed lateness re-fires are folded into the
watermark delay: ``delay = out-of-orderness + lateness``).  Rows behind the
watermark are dropped by Spark; ``lateness.stream_split_late`` keeps them.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType


def _delay(delay_s: float) -> str:
    return f"{int(round(delay_s * 1000))} milliseconds"


def _span(seconds: float) -> str:
    return f"{int(round(seconds * 1_000_000))} microseconds"


def stream_sliding_count(df: DataFrame, keys: list[str], ts: str = "ts", size_s: float = 3600,
                         slide_s: float = 300, delay_s: float = 0, lateness_s: float = 0,
                         count_col: str = "cnt", method: str = "chain") -> DataFrame:
    """Counts per key and sliding window; one final row per window.

    ``method``: ``chain`` (below) or ``native`` (one ``window()`` aggregation: the form for
    update mode, i.e. early and corrected results).  Both give the same columns.

    Chain: two chained stateful aggregations, the pane method on a stream: rows are
    counted per tumbling pane of ``slide`` (one state row per key and pane),
    then each pane total goes to the windows containing it, keyed by
    ``window(window_time(pane), size, slide)`` so the watermark carries
    through.  State holds panes, not copies of events.  Each pane total is copied
    size/slide times; ``sinks.sliding_counts_each_batch`` avoids that for long windows
    (1 day every 5 s).
    """
    if method not in ("chain", "native"):
        raise ValueError(f"unknown method {method!r}")
    if method == "native":
        # one aggregation over window(): usable in update mode, where each
        # micro-batch re-emits the corrected count of every window it changed
        # (the original's allowed-lateness re-fire); copies each event
        # size/slide times
        src = df.withWatermark(ts, _delay(delay_s + lateness_s))
        out = src.groupBy(*keys, F.window(ts, _span(size_s), _span(slide_s)).alias("window")).agg(
            F.count(F.lit(1)).alias(count_col))
        return out.select(*keys, F.unix_millis("window.end").alias("window_end_ms"),
                          F.col(count_col).cast("bigint").alias(count_col), "window")
    src = df.withWatermark(ts, _delay(delay_s + lateness_s))
    panes = src.groupBy(*keys, F.window(ts, _span(slide_s)).alias("pane")).agg(
        F.count(F.lit(1)).alias("__c"))
    if size_s == slide_s:
        out = panes.withColumnRenamed("pane", "window").withColumnRenamed("__c", count_col)
    else:
        out = (panes.groupBy(*keys, F.window(F.window_time("pane"), _span(size_s), _span(slide_s))
                             .alias("window"))
               .agg(F.sum("__c").alias(count_col)))
    return out.select(*keys, F.unix_millis("window.end").alias("window_end_ms"),
                      F.col(count_col).cast("bigint").alias(count_col), "window")


class TopNProcessor(StatefulProcessor):
    """The ``n`` best of a window's rows; keeps ``n`` of them in memory and no state."""

    def __init__(self, key_col: str, n: int, count_col: str) -> None:
        self.key_col, self.n, self.count_col = key_col, n, count_col

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        best = heapq.nsmallest(self.n, ((-r[self.count_col], r[self.key_col]) for r in rows))
        for rank, (count, item) in enumerate(best, 1):
            yield Row(**{"window_end_ms": key[0], self.key_col: item, self.count_col: -count, "rank_no": rank})

    def close(self) -> None:
        pass


def stream_top_n(counts: DataFrame, key_col: str, n: int, count_col: str = "cnt") -> DataFrame:
    """Top ``n`` per window of a windowed-count stream in append mode, where a window's final
    counts all come in one micro-batch.  Ties go to the smaller key.  Output one row per rank.

    A window's rows pass through one task, ``n`` of them held at a time;
    ``sinks.top_n_each_batch`` ranks with the batch operator instead, for windows with
    very many keys."""
    fields = [StructField("window_end_ms", LongType()), StructField(key_col, counts.schema[key_col].dataType),
              StructField(count_col, LongType()), StructField("rank_no", LongType())]
    by_end = counts.select(F.unix_millis("window.end").alias("window_end_ms"), key_col, count_col).groupBy("window_end_ms")
    return by_end.transformWithState(TopNProcessor(key_col, n, count_col), StructType(fields), "Append", "None")


def stream_unique_visitors(df: DataFrame, user: str = "user_id", ts: str = "ts",
                           size_s: float = 3600, slide_s: float = 300,
                           delay_s: float = 0) -> DataFrame:
    """Exact distinct users per sliding window: distinct (window, user) first,
    then a count per window (``count(distinct)`` is refused on streams)."""
    src = df.withWatermark(ts, _delay(delay_s))
    per_user = src.groupBy(F.window(ts, _span(size_s), _span(slide_s)).alias("window"), user).count()
    return (per_user.groupBy("window").agg(F.count(F.lit(1)).alias("uv"))
            .select(F.unix_millis("window.end").alias("window_end_ms"),
                    F.col("uv").cast("bigint").alias("uv")))


def stream_unique_visitors_hll(df: DataFrame, user: str = "user_id", ts: str = "ts",
                               window_s: float = 3600, delay_s: float = 0,
                               rsd: float = 0.01) -> DataFrame:
    """HLL estimate per tumbling window: the bounded-state distinct count."""
    src = df.withWatermark(ts, _delay(delay_s))
    return (src.groupBy(F.window(ts, _span(window_s)).alias("window"))
            .agg(F.approx_count_distinct(user, rsd).alias("uv"))
            .select(F.unix_millis("window.end").alias("window_end_ms"), "uv"))


def stream_running_unique_visitors(df: DataFrame, user: str = "user_id", ts: str = "ts",
                                   window_s: float = 3600, delay_s: float = 0,
                                   rsd: float = 0.01) -> DataFrame:
    """Distinct users so far per tumbling window, re-emitted every micro-batch
    (update output mode; the original fires its window on every element).

    One aggregation with a bounded HLL state per window, like the original's
    per-window bitmap: Spark refuses chained aggregations in update mode, and an
    exact set per window would grow with the window's visitors.  The exact
    per-event running count is the batch ``running_unique_visitors``: the rows of the
    two differ, as an estimate per micro-batch does from a count per event.
    """
    src = df.withWatermark(ts, _delay(delay_s))
    return (src.groupBy(F.window(ts, _span(window_s)).alias("window"))
            .agg(F.approx_count_distinct(user, rsd).alias("uv")))


def stream_hot_items_sql(user_behavior: DataFrame, view: str = "tidemark_stream_user_behavior",
                         n: int = 5, size_s: float = 3600, slide_s: float = 300,
                         delay_s: float = 0) -> DataFrame:
    """The SQL form on a stream: the watermarked stream is registered as a
    temp view and counted per item and sliding window in Spark SQL; streams
    refuse ``row_number``, so the ranking is the chained ``stream_top_n``.
    Output: ``window_end_ms, item_id, cnt, rank_no``."""
    spark = user_behavior.sparkSession
    user_behavior.withWatermark("ts", _delay(delay_s)).createOrReplaceTempView(view)
    counts = spark.sql(f"""
        SELECT item_id, window(ts, '{_span(size_s)}', '{_span(slide_s)}') AS window,
               count(item_id) AS cnt
        FROM {view} WHERE behavior = 'pv'
        GROUP BY item_id, window(ts, '{_span(size_s)}', '{_span(slide_s)}')""")
    return stream_top_n(counts, "item_id", n).select("window_end_ms", "item_id", "cnt", "rank_no")


def stream_unique_visitors_bitmap(df: DataFrame, user: str = "user_id", ts: str = "ts",
                                  window_s: float = 3600, delay_s: float = 0,
                                  log2_bits: int = 29) -> DataFrame:
    """Distinct bitmap offsets of the user id per tumbling window on a stream:
    the bits the original sets in its per-window bitmap, counted by a chained
    distinct (window, offset) -> count per window.  ``window_end_ms, uv``."""
    from tidemark.functions.hashing import bitmap_offset

    bits = df.withColumn("__bit", bitmap_offset(F.col(user), log2_bits))
    return stream_unique_visitors(bits, "__bit", ts, window_s, window_s, delay_s)
