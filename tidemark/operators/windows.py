"""Event-time window counts: tumbling, sliding, and long-sliding by panes.

Sliding windows of ``size`` every ``slide`` are epoch aligned and half open
``[start, end)``, as Spark's ``window()``.  Spark's ``window()`` copies every
event into ``size / slide`` rows before aggregating (12 copies for 1 h / 5 min,
17,280 for 1 day / 5 s).  Here events are first counted per key and *pane*
(a tumbling window of ``slide`` length: one row out per event, shrunk by
map-side partial aggregation), and only the pane totals are spread to windows:

* ``expand``: each pane total goes to its ``size / slide`` windows (explode of
  a short sequence) and is summed per window; a caller with few windows per pane
  may ask for it;
* ``delta`` (the default, for any ratio): each pane adds ``+c`` at its first window and ``-c`` after its
  last; a running sum over the change points per key (one a slide at most) gives run-length rows ``[end_from, end_to)`` with
  one count; dense rows are exploded from the runs only when asked for.
  Cost is proportional to panes, not to panes x ratio.

Results carry ``window_end_ms`` (and optionally ``window_start_ms``) as epoch
milliseconds, and only windows with a positive count, as the streaming
engines emit them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import floor_div, seconds_to_us
from tidemark.operators.scan import ScanAgg, segmented_scan


def _check(size_s: float, slide_s: float) -> tuple[int, int, int]:
    size_us, slide_us = seconds_to_us(size_s), seconds_to_us(slide_s)
    if slide_us <= 0 or size_us <= 0:
        raise ValueError("window size and slide must be positive")
    if size_us % slide_us:
        raise ValueError("window size must be a multiple of the slide")
    return size_us, slide_us, size_us // slide_us


def window_ratio(size_s: float, slide_s: float) -> int:
    """Panes of a window (``size / slide``)."""
    return _check(size_s, slide_s)[2]


def pane_index(ts: str | Column, slide_s: float) -> Column:
    """Index of the epoch-aligned pane (tumbling window of ``slide_s``) of ``ts``."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return floor_div(F.unix_micros(c), seconds_to_us(slide_s))


def pane_counts(df: DataFrame, keys: list[str], ts: str, slide_s: float,
                value: Column | None = None) -> DataFrame:
    """``keys, __pane, __c``: rows (or ``sum(value)``) per key and pane."""
    cols = [*keys, pane_index(ts, slide_s).alias("__pane")]
    if value is None:
        return df.select(*cols).groupBy(*keys, "__pane").agg(F.count(F.lit(1)).alias("__c"))
    return (df.select(*cols, value.alias("__v"))
            .groupBy(*keys, "__pane").agg(F.sum("__v").alias("__c")))


def _finish(df: DataFrame, keys: list[str], end_idx: str, slide_us: int, size_us: int,
            count_col: str, with_start: bool) -> DataFrame:
    slide_ms, size_ms = slide_us // 1000, size_us // 1000
    end_ms = (F.col(end_idx) * F.lit(slide_ms)).cast("bigint")
    cols = [*keys]
    if with_start:
        cols.append((end_ms - F.lit(size_ms)).alias("window_start_ms"))
    cols += [end_ms.alias("window_end_ms"), F.col(count_col).cast("bigint").alias(count_col)]
    return df.select(*cols)


def _delta_runs(df: DataFrame, keys: list[str], ts: str, slide_s: float, ratio: int) -> DataFrame:
    """``keys, __e, __next, __run``: windows ending at slide index in
    ``[__e, __next)`` all hold ``__run`` (> 0) rows."""
    return _pane_runs(pane_counts(df, keys, ts, slide_s), keys, ratio)


def _pane_runs(panes: DataFrame, keys: list[str], ratio: int) -> DataFrame:
    deltas = (panes.select(*keys, F.explode(F.array(
        F.struct((F.col("__pane") + 1).alias("e"), F.col("__c").alias("d")),
        F.struct((F.col("__pane") + ratio + 1).alias("e"), (-F.col("__c")).alias("d")),
    )).alias("__x"))
        .select(*keys, F.col("__x.e").alias("__e"), F.col("__x.d").alias("__d"))
        .groupBy(*keys, "__e").agg(F.sum("__d").alias("__d")))
    return runs_from_deltas(deltas, keys)


def runs_from_deltas(deltas: DataFrame, keys: list[str]) -> DataFrame:
    """Running sum of ``__d`` over window-end index ``__e`` per key, as runs
    ``[__e, __next)`` with value ``__run`` > 0 (zero sums dropped first).  A key has at most
    one change a slide of the time covered, whatever its events, so no key is cut."""
    deltas = deltas.filter(F.col("__d") != 0)
    # the last change of a key brings its count to 0, so every counted run has a next change
    scanned = segmented_scan(
        deltas, keys, ["__e"],
        [ScanAgg("__run", "sum", F.col("__d")), ScanAgg("__next", "next", F.col("__e"))],
        inclusive=True)
    return scanned.filter(F.col("__run") > 0).select(*keys, "__e", "__next", "__run")


def sliding_count_from_panes(panes: DataFrame, keys: list[str], size_s: float, slide_s: float,
                             count_col: str = "cnt") -> DataFrame:
    """``sliding_count`` from counted panes (``keys, __pane, __c``); a pane may come in parts."""
    size_us, slide_us, ratio = _check(size_s, slide_s)
    runs = _pane_runs(panes, keys, ratio)
    dense = runs.select(*keys, F.explode(F.sequence(F.col("__e"), F.col("__next") - 1)).alias("__end"),
                        F.col("__run").alias(count_col))
    return _finish(dense, keys, "__end", slide_us, size_us, count_col, False)


def sliding_count_runs(df: DataFrame, keys: list[str], ts: str, size_s: float, slide_s: float,
                       count_col: str = "cnt") -> DataFrame:
    """Run-length sliding counts by the delta method.

    Returns ``keys, end_from_ms, end_to_ms, cnt``: every window whose end lies in
    ``[end_from_ms, end_to_ms)`` (on the slide grid) has count ``cnt`` (> 0).
    """
    _, slide_us, ratio = _check(size_s, slide_s)
    slide_ms = F.lit(slide_us // 1000)
    runs = _delta_runs(df, keys, ts, slide_s, ratio)
    return runs.select(*keys,
                       (F.col("__e") * slide_ms).cast("bigint").alias("end_from_ms"),
                       (F.col("__next") * slide_ms).cast("bigint").alias("end_to_ms"),
                       F.col("__run").cast("bigint").alias(count_col))


def sliding_count(df: DataFrame, keys: list[str], ts: str, size_s: float, slide_s: float,
                  method: str = "delta", count_col: str = "cnt",
                  with_start: bool = False) -> DataFrame:
    """Rows per key and sliding window (one row per non-empty window).

    method: ``delta``, ``expand``, or ``native`` (Spark's ``window()``, for comparison); the
    rows are the same.
    """
    size_us, slide_us, ratio = _check(size_s, slide_s)
    if method == "native":
        w = F.window(ts, f"{size_us} microseconds", f"{slide_us} microseconds")
        out = (df.groupBy(*keys, w.alias("__w")).agg(F.count(F.lit(1)).alias(count_col))
               .withColumn("__end", (F.unix_micros(F.col("__w.end")) / F.lit(slide_us)).cast("bigint")))
        return _finish(out, keys, "__end", slide_us, size_us, count_col, with_start)
    if method == "expand":
        panes = pane_counts(df, keys, ts, slide_s)
        spread = panes.select(
            *keys, F.explode(F.sequence(F.col("__pane") + 1, F.col("__pane") + ratio)).alias("__end"),
            "__c")
        out = spread.groupBy(*keys, "__end").agg(F.sum("__c").alias(count_col))
        return _finish(out, keys, "__end", slide_us, size_us, count_col, with_start)
    if method == "delta":
        runs = _delta_runs(df, keys, ts, slide_s, ratio)
        dense = runs.select(
            *keys, F.explode(F.sequence(F.col("__e"), F.col("__next") - 1)).alias("__end"),
            F.col("__run").alias(count_col))
        return _finish(dense, keys, "__end", slide_us, size_us, count_col, with_start)
    raise ValueError(f"unknown method {method!r}")


def sliding_distinct_count(df: DataFrame, keys: list[str], value: str, ts: str,
                           size_s: float, slide_s: float, count_col: str = "uv",
                           method: str = "delta") -> DataFrame:
    """Exact distinct ``value`` per key and sliding window.

    Both methods start from the distinct (key, value, pane) rows (each visitor
    once per pane, partial aggregation map-side).

    * ``expand``: each such row goes to its size/slide windows and the distinct
      count is taken per window.
    * ``delta`` (the default): a visitor is in window ``e`` iff one of its panes lies in
      ``[e - ratio, e - 1]``.  Each pane ``p`` of a visitor covers the window
      ends ``[p + 1, p + ratio]``; minus the ends already covered by the
      visitor's previous pane ``q`` it adds ``+1`` at ``max(p + 1, q + ratio + 1)``
      and ``-1`` at ``p + ratio + 1``.  The ranges of one visitor are disjoint
      and cover exactly its windows, so the running sum of the deltas per key
      is the distinct count -- with work proportional to visitor-panes, not
      to visitor-panes x ratio (17,280 for 1 day / 5 s).
    """
    size_us, slide_us, ratio = _check(size_s, slide_s)
    panes = df.select(*keys, value, pane_index(ts, slide_s).alias("__pane")).distinct()
    if method == "expand":
        spread = panes.select(
            *keys, value,
            F.explode(F.sequence(F.col("__pane") + 1, F.col("__pane") + ratio)).alias("__end"))
        out = spread.groupBy(*keys, "__end").agg(F.count_distinct(value).alias(count_col))
        return _finish(out, keys, "__end", slide_us, size_us, count_col, False)
    if method != "delta":
        raise ValueError(f"unknown method {method!r}")
    # a visitor has one row a pane at most: as many as slides in the time covered
    prev = segmented_scan(panes, [*keys, value], ["__pane"], [ScanAgg("__q", "prev", F.col("__pane"))])
    start = F.when(F.col("__q").isNull(), F.col("__pane") + 1).otherwise(
        F.greatest(F.col("__pane") + 1, F.col("__q") + ratio + 1))
    deltas = (prev.select(*keys, F.explode(F.array(
        F.struct(start.alias("e"), F.lit(1).cast("bigint").alias("d")),
        F.struct((F.col("__pane") + ratio + 1).alias("e"), F.lit(-1).cast("bigint").alias("d")),
    )).alias("__x"))
        # an empty range adds +1 and -1 at the same end: they cancel below
        .select(*keys, F.col("__x.e").alias("__e"), F.col("__x.d").alias("__d"))
        .groupBy(*keys, "__e").agg(F.sum("__d").alias("__d")))
    runs = runs_from_deltas(deltas, keys)
    dense = runs.select(
        *keys, F.explode(F.sequence(F.col("__e"), F.col("__next") - 1)).alias("__end"),
        F.col("__run").alias(count_col))
    return _finish(dense, keys, "__end", slide_us, size_us, count_col, False)


def tumbling_index(ts: str | Column, size_s: float) -> Column:
    return pane_index(ts, size_s)


def tumbling_end_ms(ts: str | Column, size_s: float) -> Column:
    size_ms = seconds_to_us(size_s) // 1000
    return ((pane_index(ts, size_s) + 1) * F.lit(size_ms)).cast("bigint")


def channel_counts(market: DataFrame, behavior: str | None = "uninstall", size_s: float = 86400,
                   slide_s: float = 10) -> DataFrame:
    """Rows per (channel, behavior) and sliding window (defaults: 1 day every
    10 s -- 8,640 windows per event, so the delta pane method is used).

    ``behavior`` keeps one behaviour (the original keeps only ``uninstall``);
    ``None`` counts all of them.
    Output: ``channel, behavior, window_start_ms, window_end_ms, cnt``.
    """
    src = market if behavior is None else market.filter(market["behavior"] == behavior)
    return sliding_count(src, ["channel", "behavior"], "ts", size_s, slide_s, with_start=True)
