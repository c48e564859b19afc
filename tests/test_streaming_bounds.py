"""Streams whose reads and state stay bounded: expiry of panes, outer interval join, lateness by arrival."""

import itertools
import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import Window

from tests.conftest import SF_SMALL, rows
from tests.test_streaming import _no_sentinel, as_stream, run_stream
from tidemark import operators as O
from tidemark import streaming as S
from tidemark.operators.windows import pane_counts
from tidemark.sources import tables as T
from tidemark.streaming import sinks

_ids = itertools.count()
NOW = {"availableNow": True}


def name():
    return f"tidemark_b{next(_ids)}"


def test_panes_expire_and_reads_stay_constant(spark, monkeypatch):
    """60 micro-batches by foreachBatch's own function: a few folders a batch, whatever came before."""
    folder, out, slide, size, n = tempfile.mkdtemp(), tempfile.mkdtemp(), 60, 600, 60
    read, plain = [], sinks._runs_behind
    monkeypatch.setattr(sinks, "_runs_behind", lambda fresh, before, *a: read.append(len(before)) or plain(fresh, before, *a))
    events = spark.range(0, n * 120, 7).select((F.col("id") % 3).alias("k"), F.timestamp_seconds("id").alias("ts"))
    panes = pane_counts(events, ["k"], "ts", slide).collect()
    for b in range(n):
        mine = [r for r in panes if r["__pane"] // 2 == b]
        batch = spark.createDataFrame(mine, "k bigint, __pane bigint, __c bigint").coalesce(1)
        for _ in range(2 if b == 30 else 1):     # a replayed batch
            sinks._slide(batch, max(r["__pane"] for r in mine), ["k"], size, slide, folder, f"{out}/batch_id={b}", "cnt")
    sinks.finish_sliding_counts(spark, ["k"], size, slide, folder, out)
    got = spark.read.parquet(out)
    assert rows(got, ["k", "window_end_ms", "cnt"]) == rows(O.sliding_count(events, ["k"], "ts", size, slide))
    assert max(read) == read[20] == read[-2] <= size // slide // 2 + 2
    assert len([f for f in os.listdir(folder) if f.startswith("panes_")]) <= size // slide // 2 + 2
    assert len([f for f in os.listdir(folder) if f.startswith("carry_")]) == 2


def test_outer_interval_join_stream(spark):
    ev = T.events(spark, SF_SMALL)
    pays, recs = T.payments(ev), T.receipts(ev).select("event_id", "tx_id", "ts")
    out = S.stream_tx_interval_join(as_stream(spark, pays, ["tx_id"]), as_stream(spark, recs, ["tx_id"]),
                                    3 * 3600, 5 * 3600, how="full_outer")
    cols = ["tx_id", "pay_event_id", "receipt_event_id"]
    got = _no_sentinel(run_stream(out), "tx_id")
    p, r = pays.alias("p"), recs.alias("r")
    at, to = F.unix_micros("p.ts"), F.unix_micros("r.ts")
    full = p.join(r, (F.col("p.tx_id") == F.col("r.tx_id")) & (to >= at - 3 * 3600 * 1_000_000)
                  & (to <= at + 5 * 3600 * 1_000_000), "full_outer")
    want = full.select(F.coalesce("p.tx_id", "r.tx_id").alias("tx_id"), F.col("p.event_id").alias("pay_event_id"),
                       F.col("r.event_id").alias("receipt_event_id"))
    assert rows(got, cols) == rows(want, cols)
    assert want.filter("pay_event_id IS NULL").count() and want.filter("receipt_event_id IS NULL").count()


def test_late_rows_by_arrival_are_those_of_the_batch_form(spark):
    ev = T.with_arrival(T.events(spark, SF_SMALL)).select("event_id", "ts", "arrival_us")
    batch = O.split_late(ev, F.col("arrival_us"), "ts", "event_id", 3600, None, 64, 60)
    want = rows(batch.filter("is_late"), ["event_id"])
    assert want
    for n_files in (1, 5):
        path, out = tempfile.mkdtemp(), tempfile.mkdtemp()
        cut = ev.withColumn("__t", F.ntile(n_files).over(Window.orderBy("arrival_us", "event_id")))
        for i in range(1, n_files + 1):
            cut.filter(F.col("__t") == i).drop("__t").coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(path)
        S.stream_split_late(stream, out, name(), 3600, None, 64, 60, checkpoint=tempfile.mkdtemp(), trigger=NOW,
                            arrival_us=F.col("arrival_us")).awaitTermination(300)
        got = spark.read.parquet(out)
        assert got.count() == ev.count()
        assert rows(got.filter("is_late"), ["event_id"]) == want
