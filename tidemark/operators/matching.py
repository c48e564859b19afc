"""Payment / receipt reconciliation: interval join and one-to-one matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import floor_div, seconds_to_us
from tidemark.operators.scan import ScanAgg, chunks_for, segmented_scan


def _side(df: DataFrame, key: str, order_id: str, prefix: str) -> DataFrame:
    """key, event id, time, and the whole record as a struct."""
    return df.select(key, F.col(order_id).alias(f"{prefix}_event_id"),
                     F.unix_micros("ts").alias(f"__{prefix}_ts"), F.struct(*df.columns).alias(prefix))


def tx_interval_join(pays: DataFrame, receipts: DataFrame, before_s: float = 3, after_s: float = 5,
                     key: str = "tx_id", order_id: str = "event_id") -> DataFrame:
    """Every (pay, receipt) pair of one key with
    ``pay.ts - before <= receipt.ts <= pay.ts + after`` (both bounds inclusive).

    Time is cut into buckets as wide as the interval; each receipt sits in its
    one bucket and each pay is sent to the (at most two) buckets its interval
    touches, so the equi-join on ``(key, bucket)`` only meets rows that can be
    within range -- a key with years of events never pairs all its rows.  Each
    pair is produced once (in the receipt's bucket).
    Rows without a key pair with nothing.
    Output: ``tx_id, pay_event_id, receipt_event_id, pay_ms, receipt_ms, pay, receipt``;
    the last two are the whole records.
    """
    b_us, a_us = seconds_to_us(before_s), seconds_to_us(after_s)
    width = max(b_us + a_us, 1)
    p = _side(pays, key, order_id, "pay")
    p = p.withColumn("__b", F.explode(F.sequence(floor_div(F.col("__pay_ts") - F.lit(b_us), width),
                                                 floor_div(F.col("__pay_ts") + F.lit(a_us), width))))
    r = _side(receipts, key, order_id, "receipt")
    r = r.withColumn("__b", floor_div(F.col("__receipt_ts"), width))
    j = p.join(r, [key, "__b"]).filter(
        F.col("__receipt_ts").between(F.col("__pay_ts") - F.lit(b_us), F.col("__pay_ts") + F.lit(a_us)))
    return j.select(key, "pay_event_id", "receipt_event_id",
                    floor_div(F.col("__pay_ts"), 1000).alias("pay_ms"),
                    floor_div(F.col("__receipt_ts"), 1000).alias("receipt_ms"), "pay", "receipt")


def tx_match(pays: DataFrame, receipts: DataFrame, wait_s: float = 3, key: str = "tx_id",
             order_id: str = "event_id", chunk_us: int | None = None,
             pay_filter: Column | None = None) -> DataFrame:
    """One-to-one reconciliation of two streams sharing a key, one slot per key.

    A pay waits in the slot for ``wait_s``; the next event of the key, if it is a receipt
    that comes in that time (bound included), takes it and both are ``matched``.  A
    new pay takes the slot of an older one.  Every other row of either side is
    reported once, unmatched, and so is a row without a key.  At equal times pays
    come before receipts, then ids decide.  ``pay_filter`` keeps the order events that
    are pays (e.g. a non-null transaction id).

    Both sides are scanned once, together, in the order of each key: a row only needs
    the events before and behind it.
    Output: ``tx_id, kind, pay_event_id, receipt_event_id, pay_ms, receipt_ms, pay,
    receipt`` with kind ``matched`` / ``order_only`` / ``receipt_only``; the last two are
    the whole records.
    """
    if pay_filter is not None:
        pays = pays.filter(pay_filter)
    kinds = [dict(df.dtypes)[key] for df in (pays, receipts)]
    if kinds[0] != kinds[1]:
        raise ValueError(f"{key} is {kinds[0]} in the pays and {kinds[1]} in the receipts")

    def side(df: DataFrame, other: DataFrame, receipt: bool) -> DataFrame:
        own, none = F.struct(*df.columns), F.lit(None).cast(other.select(F.struct(*other.columns).alias("r")).schema["r"].dataType)
        return df.select(key, F.col(order_id).alias("__id"), F.unix_micros("ts").alias("__ts"),
                         (F.unix_micros("ts") * 2 + int(receipt)).alias("__ord"), F.lit(receipt).alias("__receipt"),
                         (none if receipt else own).alias("pay"), (own if receipt else none).alias("receipt"))
    both = side(pays, receipts, False).unionByName(side(receipts, pays, True))
    near = F.struct(F.col("__id").alias("id"), F.col("__ts").alias("ts"), F.col("__receipt").alias("receipt"))
    scanned = segmented_scan(
        both, [key], ["__ord", "__id"],
        [ScanAgg("__p", "prev", near.withField("pay", F.col("pay"))), ScanAgg("__n", "next", near)],
        chunks_for(both, "__ts", chunk_us))
    wait = F.lit(seconds_to_us(wait_s))
    named = F.col(key).isNotNull()

    def taken(pay_ts: Column, receipt_ts: Column) -> Column:
        return named & (receipt_ts - pay_ts <= wait)
    got = F.coalesce(F.col("__receipt") & ~F.col("__p.receipt") & taken(F.col("__p.ts"), F.col("__ts")), F.lit(False))
    gone = F.coalesce(~F.col("__receipt") & F.col("__n.receipt") & taken(F.col("__ts"), F.col("__n.ts")), F.lit(False))
    ms = floor_div(F.col("__ts"), 1000)
    is_pay = ~F.col("__receipt")
    return scanned.filter(~gone).select(
        key, F.when(got, F.lit("matched")).when(is_pay, F.lit("order_only")).otherwise(F.lit("receipt_only")).alias("kind"),
        F.when(is_pay, F.col("__id")).when(got, F.col("__p.id")).alias("pay_event_id"),
        F.when(F.col("__receipt"), F.col("__id")).alias("receipt_event_id"),
        F.when(is_pay, ms).when(got, floor_div(F.col("__p.ts"), 1000)).alias("pay_ms"),
        F.when(F.col("__receipt"), ms).alias("receipt_ms"),
        F.when(got, F.col("__p.pay")).otherwise(F.col("pay")).alias("pay"), "receipt")
