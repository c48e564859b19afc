"""Page-view and unique-visitor counts: exact, salted, bitmap, sketch, running."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.constants import BITMAP_LOG2_BITS
from tidemark.functions.hashing import bitmap_offset
from tidemark.operators.scan import ScanAgg, chunks_for, segmented_scan
from tidemark.operators.windows import (
    _check,
    _finish,
    pane_index,
    sliding_count,
    sliding_distinct_count,
    tumbling_end_ms,
    tumbling_index,
)


def page_views(df: DataFrame, ts: str = "ts", size_s: float = 3600, slide_s: float = 300,
               method: str = "expand") -> DataFrame:
    """Total rows per sliding window: ``window_end_ms, cnt``."""
    return sliding_count(df, [], ts, size_s, slide_s, method)


def page_views_salted(df: DataFrame, ts: str = "ts", size_s: float = 3600, slide_s: float = 300,
                      salt_buckets: int = 10, salt_of: Column | None = None) -> DataFrame:
    """Two-stage count: per (salt, pane), then per window across salts.

    The original spreads one constant key over random salts so that no single
    task counts a whole window.  The salt here is a hash of the row id (or of
    ``salt_of``), so a retried task recomputes the same split.  Spark's partial
    aggregation already removes the hot key; the operator is kept because the
    original exposes it, and gives the same numbers as ``page_views``.
    """
    size_us, slide_us, ratio = _check(size_s, slide_s)
    salt = F.pmod(F.xxhash64(salt_of if salt_of is not None else F.col("event_id")),
                  F.lit(salt_buckets))
    stage1 = (df.select(salt.alias("__salt"), pane_index(ts, slide_s).alias("__pane"))
              .groupBy("__salt", "__pane").agg(F.count(F.lit(1)).alias("__c")))
    spread = stage1.select(
        "__salt", F.explode(F.sequence(F.col("__pane") + 1, F.col("__pane") + ratio)).alias("__end"),
        "__c")
    partial = spread.groupBy("__salt", "__end").agg(F.sum("__c").alias("__c"))
    total = partial.groupBy("__end").agg(F.sum("__c").alias("cnt"))
    return _finish(total, [], "__end", slide_us, size_us, "cnt", False)


def unique_visitors(df: DataFrame, user: str = "user_id", ts: str = "ts",
                    size_s: float = 3600, slide_s: float = 300) -> DataFrame:
    """Exact distinct users per sliding window: ``window_end_ms, uv``."""
    return sliding_distinct_count(df, [], user, ts, size_s, slide_s, "uv")


def unique_visitors_bitmap(df: DataFrame, user: str = "user_id", ts: str = "ts",
                           window_s: float = 3600, log2_bits: int = BITMAP_LOG2_BITS) -> DataFrame:
    """Distinct bitmap offsets of the user id per tumbling window.

    Equal to the count of bits the original sets in its per-window bitmap: two
    users whose ids hash to one offset count once.  ``window_end_ms, uv``.
    """
    return (df.select(tumbling_end_ms(ts, window_s).alias("window_end_ms"),
                      bitmap_offset(F.col(user), log2_bits).alias("__bit"))
            .groupBy("window_end_ms").agg(F.count_distinct("__bit").alias("uv")))


def visitor_bitmaps(df: DataFrame, user: str = "user_id", ts: str = "ts", window_s: float = 3600,
                    log2_bits: int = BITMAP_LOG2_BITS) -> DataFrame:
    """The bitmaps themselves, a table to store: ``window_end_ms, bucket, bits``.

    A window's bitmap is kept in buckets of 32,768 bits (4 KB), only those with a bit set.
    Tasks set bits before the shuffle, so what is shuffled is buckets, never offsets:
    2^29 bits are at most 16,384 buckets a window whatever the number of events."""
    offset = bitmap_offset(F.col(user), log2_bits) + 1
    return (df.filter(F.col(user).isNotNull())
            .select(tumbling_end_ms(ts, window_s).alias("window_end_ms"), offset.alias("__bit"))
            .select("window_end_ms", F.bitmap_bucket_number("__bit").alias("bucket"),
                    F.bitmap_bit_position("__bit").alias("__at"))
            .groupBy("window_end_ms", "bucket").agg(F.bitmap_construct_agg("__at").alias("bits")))


def merge_visitor_bitmaps(*bitmaps: DataFrame) -> DataFrame:
    """One table of bitmaps from several (e.g. the stored one and that of new events): bitwise or."""
    merged = bitmaps[0]
    for more in bitmaps[1:]:
        merged = merged.unionByName(more)
    return merged.groupBy("window_end_ms", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def rollup_visitor_bitmaps(bitmaps: DataFrame, window_s: float = 86400) -> DataFrame:
    """Bitmaps of coarser windows (hours into days) by bitwise or; the events are not read again."""
    return merge_visitor_bitmaps(bitmaps.withColumn("window_end_ms", _coarse_end_ms(window_s)))


def count_visitor_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """Bits set per window: ``window_end_ms, uv``."""
    return (bitmaps.select("window_end_ms", F.bitmap_count("bits").alias("__n"))
            .groupBy("window_end_ms").agg(F.sum("__n").alias("uv")))


def visitor_bits(bitmaps: DataFrame, probes: DataFrame, user: str = "user_id",
                 log2_bits: int = BITMAP_LOG2_BITS) -> DataFrame:
    """``probes`` (``window_end_ms`` and a user, other columns kept) with ``seen``: whether the
    user's bit is set in the window's bitmap.  One join on (window, bucket)."""
    at = bitmap_offset(F.col(user), log2_bits) + 1
    asked = probes.withColumns({"bucket": F.bitmap_bucket_number(at), "__at": F.bitmap_bit_position(at)})
    found = asked.join(bitmaps.select("window_end_ms", "bucket", "bits"), ["window_end_ms", "bucket"], "left")
    byte = F.conv(F.hex(F.substring("bits", (F.col("__at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.getbit(byte, (F.col("__at") % 8).cast("int"))
    return found.withColumn("seen", F.coalesce(bit == 1, F.lit(False))).select(*probes.columns, "seen")


def _coarse_end_ms(window_s: float) -> Column:
    size_ms = int(window_s * 1000)
    return ((F.floor((F.col("window_end_ms") - 1) / F.lit(size_ms)) + 1) * F.lit(size_ms)).cast("bigint")


def unique_visitors_hll(df: DataFrame, user: str = "user_id", ts: str = "ts",
                        window_s: float = 3600, rsd: float = 0.01) -> DataFrame:
    """HyperLogLog++ estimate of distinct users per tumbling window (bounded state)."""
    return (df.select(tumbling_end_ms(ts, window_s).alias("window_end_ms"), user)
            .groupBy("window_end_ms").agg(F.approx_count_distinct(user, rsd).alias("uv")))


def unique_visitors_sketch(df: DataFrame, user: str = "user_id", ts: str = "ts",
                           window_s: float = 3600, lg_k: int = 12) -> DataFrame:
    """Mergeable HLL sketch per tumbling window (``hll_sketch_agg``): the binary
    sketch can be stored and unioned later, e.g. to roll hours up to days."""
    return (df.select(tumbling_end_ms(ts, window_s).alias("window_end_ms"), user)
            .groupBy("window_end_ms")
            .agg(F.hll_sketch_agg(F.col(user), lg_k).alias("sketch"))
            .select("window_end_ms", F.hll_sketch_estimate("sketch").alias("uv"), "sketch"))


def running_unique_visitors(df: DataFrame, user: str = "user_id", ts: str = "ts",
                            order_id: str = "event_id", window_s: float = 3600,
                            chunk_us: int | None = None) -> DataFrame:
    """Distinct users so far, per event, within its tumbling window.

    The original fires its window on every element and upserts the running
    count.  Here an event is a user's first in its window if the user has no
    event before it there (a scan per window and user), and the running count of
    first events is a scan per window; both are cut in chunks where a key is
    heavy.  Output: ``window_end_ms, event_id, user_id, uv``.
    """
    base = df.select(order_id, user, F.unix_micros(ts).alias("__ts"),
                     tumbling_index(ts, window_s).alias("__w"))
    order = ["__ts", order_id]
    flagged = segmented_scan(base, ["__w", user], order, [ScanAgg("__p", "prev", F.lit(1))],
                             chunks_for(base, "__ts", chunk_us))
    scanned = segmented_scan(flagged, ["__w"], order, [ScanAgg("__uv", "sum", F.col("__p").isNull().cast("bigint"))],
                             chunks_for(base, "__ts", chunk_us), inclusive=True)
    size_ms = int(window_s * 1000)
    return scanned.select(((F.col("__w") + 1) * F.lit(size_ms)).cast("bigint").alias("window_end_ms"),
                          order_id, user, F.col("__uv").cast("bigint").alias("uv"))


__all__ = ["count_visitor_bitmaps", "merge_visitor_bitmaps", "page_views", "page_views_salted",
           "rollup_visitor_bitmaps", "running_unique_visitors", "unique_visitors", "unique_visitors_bitmap",
           "unique_visitors_hll", "unique_visitors_sketch", "visitor_bitmaps", "visitor_bits"]


def rollup_visitor_sketches(sketches: DataFrame, window_s: float = 86400) -> DataFrame:
    """Merge per-window sketches (``unique_visitors_sketch``) into coarser
    tumbling windows (e.g. hours into days) without reading the events again:
    a union of HLL sketches is exact, so the estimate equals sketching the
    coarse window directly.  ``window_end_ms, uv, sketch``.
    """
    return (sketches.groupBy(_coarse_end_ms(window_s).alias("window_end_ms"))
            .agg(F.hll_union_agg("sketch").alias("sketch"))
            .select("window_end_ms", F.hll_sketch_estimate("sketch").alias("uv"), "sketch"))
