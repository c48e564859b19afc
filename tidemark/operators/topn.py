"""Top-N per window (hot items, hot pages) and the text report of a ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.constants import REPORT_HEADER, REPORT_LINE, REPORT_SEPARATOR

# Keys that a pane's frequent-items summary tracks, and candidates counted exactly per window.
SUMMARY_ITEMS = 4096
SUMMARY_KEPT = 64


def top_n(counts: DataFrame, group_col: str, key_col: str, n: int,
          count_col: str = "cnt", rank_col: str = "rank_no") -> DataFrame:
    """The ``n`` largest ``count_col`` per ``group_col``, ties by ``key_col`` ascending.

    ``row_number() <= n`` is planned by Catalyst as a partial ``WindowGroupLimit``
    before the shuffle, so each map task sends at most ``n`` rows per group and
    a window with many keys is not shuffled whole.  Ranks are 1-based.
    """
    w = Window.partitionBy(group_col).orderBy(F.col(count_col).desc(), F.col(key_col).asc())
    ranked = counts.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)
    return ranked.withColumn(rank_col, F.col(rank_col).cast("bigint"))


def format_top_n_report(ranked: DataFrame, group_col: str = "window_end_ms",
                        key_col: str = "item_id", count_col: str = "cnt",
                        rank_col: str = "rank_no") -> DataFrame:
    """One text block per window: header with the window end, one line per rank
    (0-based, as printed by the original), then a separator line.

    Each group holds at most ``n`` ranked rows, so the ``collect_list`` is bounded.
    """
    line = F.format_string(REPORT_LINE, (F.col(rank_col) - 1).cast("int"),
                           F.col(key_col).cast("long"), F.col(count_col).cast("long"))
    lines = (ranked.groupBy(group_col)
             .agg(F.sort_array(F.collect_list(F.struct(rank_col, line.alias("line")))).alias("__l")))
    # the text of the instant just before the window end, millisecond digits
    end_text = F.date_format(F.timestamp_millis(F.col(group_col) - 1), "yyyy-MM-dd HH:mm:ss.SSS")
    return lines.select(
        group_col,
        F.concat_ws("\n", F.concat(F.lit(REPORT_HEADER), end_text),
                    F.array_join(F.transform("__l", lambda x: x["line"]), "\n"),
                    F.lit(REPORT_SEPARATOR)).alias("report"))


def hot_items(user_behavior: DataFrame, n: int = 5, size_s: float = 3600, slide_s: float = 300,
              behavior: str = "pv", method: str = "expand") -> DataFrame:
    """Top ``n`` items by views per sliding window (defaults: 1 h every 5 min, top 5; 12 windows
    per pane, so pane totals are spread to them).

    Output: ``window_end_ms, item_id, cnt, rank_no``.
    """
    from tidemark.operators.windows import sliding_count

    views = user_behavior.filter(user_behavior["behavior"] == behavior)
    counts = sliding_count(views, ["item_id"], "ts", size_s, slide_s, method)
    return top_n(counts, "window_end_ms", "item_id", n).select("window_end_ms", "item_id", "cnt", "rank_no")


def sliding_top_n(df: DataFrame, key: str, n: int, size_s: float, slide_s: float, ts: str = "ts",
                  tracked: int = SUMMARY_ITEMS, kept: int = SUMMARY_KEPT) -> DataFrame:
    """Exact top ``n`` keys per sliding window for very many keys: no row per (key, window).

    1. every pane gets a frequent-items summary of ``tracked`` keys, made where the rows are; those of
       a window's panes are merged, and name its ``kept`` most frequent keys;
    2. only these candidates are counted exactly, from the panes of the window;
    3. a key that is no candidate has at most ``unnamed`` rows in the window: the least estimate of a
       full list, and ``7 / tracked`` of the window's rows once a summary may have dropped keys (it
       errs by at most half of that).  A window whose n-th candidate has more rows than that is done;
    4. the others, whose rows spread too evenly for a summary, are counted over all their keys.

    Output: ``window_end_ms, <key>, cnt, rank_no``, equal to ``top_n`` of ``sliding_count``.
    """
    from tidemark.operators.windows import pane_counts, pane_index, window_ratio

    if not n <= kept <= tracked:
        raise ValueError("at least n and at most tracked candidates must be kept")
    ratio, slide_ms = window_ratio(size_s, slide_s), int(round(slide_s * 1000))
    ends = F.explode(F.sequence(F.col("__pane") + 1, F.col("__pane") + ratio)).alias("__end")
    summaries = (df.select(F.col(key).alias("__key"), pane_index(ts, slide_s).alias("__pane")).groupBy("__pane")
                 .agg(F.expr(f"approx_top_k_accumulate(__key, {tracked})").alias("__s"), F.count(F.lit(1)).alias("__n")))
    merged = (summaries.select(ends, "__s", "__n").groupBy("__end")
              .agg(F.expr("approx_top_k_combine(__s)").alias("__s"), F.sum("__n").alias("__n")))
    named = merged.select("__end", "__n", F.expr(f"approx_top_k_estimate(__s, {kept})").alias("__top"))
    full = F.size("__top") == kept
    error = F.when(F.col("__n") > tracked, F.ceil(F.col("__n") * 7 / tracked)).otherwise(F.lit(0))
    unnamed = F.greatest(error, F.when(full, F.array_min("__top.count")).otherwise(F.lit(0)))
    listed = named.select("__end", unnamed.alias("__unnamed"), F.explode_outer("__top").alias("__t"))
    # (a window without a candidate keeps one row, that no pane matches)
    of_panes = F.when(F.col("__t").isNotNull(), F.sequence(F.col("__end") - ratio, F.col("__end") - 1)) \
        .otherwise(F.array(F.lit(None).cast("bigint")))
    asked = listed.select("__end", "__unnamed", F.col("__t.item").alias("__want"), F.explode(of_panes).alias("__at"))

    panes = pane_counts(df.withColumnRenamed(key, "__key"), ["__key"], ts, slide_s)
    counted = (asked.join(panes, F.col("__want").eqNullSafe(F.col("__key")) & (F.col("__at") == F.col("__pane")), "left")
               .groupBy("__end", "__want", "__unnamed").agg(F.sum("__c").alias("cnt")))
    # the n-th candidate decides; with nothing unnamed, the candidates are all keys there are
    window = Window.partitionBy("__end")
    best = top_n(counted, "__end", "__want", n).withColumn(
        "__done", (F.col("__unnamed") == 0) | ((F.count("cnt").over(window) == n)
                                               & (F.min("cnt").over(window) > F.col("__unnamed"))))
    done = best.filter("__done").select("__end", F.col("__want").alias("__key"), "cnt", "rank_no")

    open_ends = best.filter("NOT __done").select("__end").distinct()
    open_panes = open_ends.select(F.explode(F.sequence(F.col("__end") - ratio, F.col("__end") - 1)).alias("__pane")).distinct()
    spread = panes.join(open_panes, "__pane", "left_semi").select("__key", ends, "__c").join(open_ends, "__end", "left_semi")
    rest = top_n(spread.groupBy("__end", "__key").agg(F.sum("__c").alias("cnt")), "__end", "__key", n)
    found = done.unionByName(rest.select(done.columns))
    return found.select((F.col("__end") * F.lit(slide_ms)).cast("bigint").alias("window_end_ms"),
                        F.col("__key").alias(key), F.col("cnt").cast("bigint").alias("cnt"), "rank_no")


def hot_pages(access_log: DataFrame, n: int = 3, size_s: float = 600, slide_s: float = 10,
              http_method: str = "GET") -> DataFrame:
    """Top ``n`` URLs by requests per sliding window (defaults: 10 min every 10 s, top 3).

    Output: ``window_end_ms, url, cnt, rank_no``.
    """
    from tidemark.operators.windows import sliding_count

    gets = access_log.filter(access_log["method"] == http_method)
    counts = sliding_count(gets, ["url"], "ts", size_s, slide_s)
    return top_n(counts, "window_end_ms", "url", n).select("window_end_ms", "url", "cnt", "rank_no")
