"""Late-data side output on a stream.

Spark's windowed aggregations drop rows behind the watermark silently.  Here every
micro-batch is split by plain column expressions: a row is late when even its last
window ended more than ``lateness`` before the watermark, the largest event time of
the earlier micro-batches minus the delay (Spark's own definition).  Both
outputs keep the whole rows.

That watermark stands still within a micro-batch, so tags depend on batch cuts.  Given a
column of the rows' arrival (a source offset, an arrival time), the running maximum in arrival order
inside the micro-batch counts as well: the tags are then those of the batch form
``operators.split_late``, however the input is cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.time import floor_div, seconds_to_us
from tidemark.operators.scan import ScanAgg, chunks_for, segmented_scan
from tidemark.streaming.sinks import Marks, foreach_batch


def stream_split_late(df: DataFrame, path: str, name: str, size_s: float = 3600, slide_s: float | None = None,
                      delay_s: float = 64, lateness_s: float = 60, ts: str = "ts", checkpoint: str | None = None,
                      trigger: dict | None = None, arrival_us: Column | None = None,
                      order_id: str = "event_id") -> StreamingQuery:
    """Write every row of ``df`` to ``path`` as parquet, with ``watermark_ms``, ``window_end_ms``
    (of its last window), ``is_late`` and the partition column ``batch_id``.

    ``read.parquet(path).filter("is_late")`` is the side output, the rest the main
    stream.  A replayed batch replaces its own output.

    ``arrival_us`` (bigint, ties by ``order_id``) orders the rows of a micro-batch as they arrived; batches
    must come in that order too.  The scan cuts long micro-batches in chunks, so no task holds one whole."""
    slide_us = seconds_to_us(slide_s if slide_s is not None else size_s)
    size_us, late_us, delay_us = seconds_to_us(size_s), seconds_to_us(lateness_s), seconds_to_us(delay_s)
    folder = path.rstrip("/")
    marks = Marks(f"{folder}/_marks")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            seen = marks.before(batch.sparkSession, batch_id)      # largest event time so far, us
            newest = F.lit(seen).cast("bigint")
            rows = batch
            if arrival_us is not None:
                rows = batch.withColumn("__arr", arrival_us)
                rows = segmented_scan(rows, [], ["__arr", order_id], [ScanAgg("__max", "max", F.unix_micros(ts))],
                                      chunks_for(rows, "__arr"))
                newest = F.greatest(newest, F.col("__max"))
            wm = newest - F.lit(delay_us)
            end = floor_div(F.unix_micros(ts), slide_us) * slide_us + size_us
            tagged = rows.withColumns({
                "window_end_ms": floor_div(end, 1000), "watermark_ms": floor_div(wm, 1000),
                "is_late": F.coalesce(end + late_us <= wm, F.lit(False))}).drop("__arr", "__max")
            tagged.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")
            last = batch.agg(F.max(F.unix_micros(ts))).first()[0]
            marks.put(batch.sparkSession, batch_id, last if seen is None else seen if last is None else max(seen, last))
        finally:
            batch.unpersist()

    return foreach_batch(df, write, name, "append", checkpoint, trigger)
