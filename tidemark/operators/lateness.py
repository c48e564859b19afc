"""Late-data side output for event-time windows.

A bounded-out-of-orderness watermark is the largest event time seen so far
minus ``delay``.  A window operator with ``allowed lateness`` drops (and sends
to a side output) an event when even its last window has ended more than
``lateness`` before the watermark.  Spark's streaming windows drop such rows
silently; ``split_late`` tags them instead.

In batch the watermark an event meets is the running max of event time over
the events that *arrived* before it.  That global running max is a segmented
scan in arrival order: a max per arrival chunk, a prefix max over the (few)
chunks, and a sorted max only within each chunk -- never one task for all rows.
The arrival chunks are sized from the number of rows and their time span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import floor_div, seconds_to_us
from tidemark.operators.scan import ScanAgg, chunks_for, segmented_scan


def split_late(df: DataFrame, arrival_us: Column, ts: str = "ts", order_id: str = "event_id",
               size_s: float = 3600, slide_s: float | None = None, delay_s: float = 64,
               lateness_s: float = 60, chunk_us: int | None = None, chunk_rows: int | None = None) -> DataFrame:
    """Add ``watermark_us``, ``last_window_end_us`` and ``is_late`` to every row.

    arrival_us: arrival time (epoch us) giving the order the stream saw rows in.
    A row is late iff ``end of its last window + lateness <= watermark`` where
    the watermark excludes the row itself.  Windows are tumbling
    (``slide_s=None``) or sliding.
    """
    slide_us = seconds_to_us(slide_s if slide_s is not None else size_s)
    size_us = seconds_to_us(size_s)
    base = df.withColumn("__arr", arrival_us).withColumn("__ts", F.unix_micros(ts))
    scanned = segmented_scan(base, [], ["__arr", order_id],
                             [ScanAgg("__max", "max", F.col("__ts"))],
                             chunks_for(base, "__arr", chunk_us, chunk_rows))
    last_end = floor_div(F.col("__ts"), slide_us) * F.lit(slide_us) + F.lit(size_us)
    wm = F.col("__max") - F.lit(seconds_to_us(delay_s))
    return (scanned
            .withColumn("watermark_us", wm)
            .withColumn("last_window_end_us", last_end)
            .withColumn("is_late", F.coalesce(last_end + F.lit(seconds_to_us(lateness_s)) <= wm,
                                              F.lit(False)))
            .drop("__max", "__ts", "__arr"))
