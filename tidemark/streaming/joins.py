"""Stream-stream interval join (payments with receipts of the same tx id)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_tx_interval_join(pays: DataFrame, receipts: DataFrame, before_s: float = 3,
                            after_s: float = 5, delay_s: float = 0, key: str = "tx_id",
                            order_id: str = "event_id", how: str = "inner") -> DataFrame:
    """Join with ``pay.ts - before <= receipt.ts <= pay.ts + after``, ``how``: ``inner`` or an outer
    join (``full_outer`` also gives the payments without receipt and the receipts without payment,
    those without a key included).

    Both sides carry a watermark; the time-range condition lets Spark drop a
    row's join state once the other side's watermark has passed its range, so
    state stays bounded by the rows of one interval; then a row that found no partner is
    given with nulls on the other side, once.  ``pay`` and ``receipt`` are the
    whole records.
    """
    wm = f"{int(round(delay_s * 1000))} milliseconds"
    p = pays.withWatermark("ts", wm).select(
        F.col(key).alias("__pk"), F.col(order_id).alias("pay_event_id"), F.col("ts").alias("__pts"),
        F.struct(*pays.columns).alias("pay"))
    r = receipts.withWatermark("ts", wm).select(
        F.col(key).alias("__rk"), F.col(order_id).alias("receipt_event_id"), F.col("ts").alias("__rts"),
        F.struct(*receipts.columns).alias("receipt"))
    b_us, a_us = int(round(before_s * 1e6)), int(round(after_s * 1e6))
    cond = ((F.col("__pk") == F.col("__rk"))
            & (F.col("__rts") >= F.col("__pts") - F.expr(f"INTERVAL {b_us} MICROSECONDS"))
            & (F.col("__rts") <= F.col("__pts") + F.expr(f"INTERVAL {a_us} MICROSECONDS")))
    return p.join(r, cond, how).select(
        F.coalesce("__pk", "__rk").alias(key), "pay_event_id", "receipt_event_id",
        F.unix_millis("__pts").alias("pay_ms"), F.unix_millis("__rts").alias("receipt_ms"), "pay", "receipt")
