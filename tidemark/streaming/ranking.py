"""Rankings and distinct counts held in keyed state and corrected row by row.

Both processors emit at once instead of waiting for the watermark, and drop a window's state by a
timer when the watermark has passed its end."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, DataType, LongType, StructField, StructType

from tidemark.functions.time import seconds_to_us
from tidemark.operators.topn import top_n
from tidemark.operators.windows import pane_index, tumbling_end_ms, window_ratio


def _long(name: str) -> StructField:
    return StructField(name, LongType())


class RankingProcessor(StatefulProcessor):
    """Counts per key of one window, and its ``n`` best keys in order.

    Counts only grow, so a key outside the ranking can enter it only when its own count
    changes: the ordered index needs the ``n`` best keys and no others."""

    def __init__(self, key_col: str, key_type: DataType, n: int) -> None:
        self.key_col, self.key_type, self.n = key_col, key_type, n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        one = StructType([StructField("key", self.key_type)])
        self.counts = handle.getMapState("counts", one, StructType([_long("cnt")]))
        self.best = handle.getValueState("best", StructType([
            StructField("keys", ArrayType(self.key_type)), StructField("cnts", ArrayType(LongType())), _long("version")]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        keys, cnts, version = self.best.get() if self.best.exists() else ([], [], 0)
        if not version:
            self.handle.registerTimer(key[0])
        old = list(zip(keys, cnts))
        ranked = dict(old)
        for item, more in Counter(r[self.key_col] for r in rows).items():
            known = self.counts.getValue((item,)) if self.counts.containsKey((item,)) else (0,)
            self.counts.updateValue((item,), (known[0] + more,))
            ranked[item] = known[0] + more
        # ties go to the smaller key, nulls first, as in the batch ranking
        new = sorted(ranked.items(), key=lambda kc: (-kc[1], kc[0] is not None, kc[0]))[:self.n]
        self.best.update(([k for k, _ in new], [c for _, c in new], version + 1))
        return iter([Row(**{"window_end_ms": key[0], "part": key[1], "rank_no": rank, self.key_col: kc[0], "cnt": kc[1],
                            "version": version + 1})
                     for rank, kc in enumerate(new, 1) if rank > len(old) or old[rank - 1] != kc])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.counts.clear()
        self.best.clear()
        return iter([])

    def close(self) -> None:
        pass


def stream_ranking_changes(df: DataFrame, key_col: str, n: int, size_s: float, slide_s: float, ts: str = "ts",
                           delay_s: float = 0, lateness_s: float = 0, parts: int = 1) -> DataFrame:
    """Changes of the top ``n`` per sliding window, in update mode: a row for every rank that another key
    or count takes, ``window_end_ms, part, rank_no, <key>, cnt, version``; late rows within
    ``lateness_s`` correct the ranking, then its state is dropped.

    The rows of a (window, part) go through one task; ``parts`` deals a window's keys by hash when it has
    more rows than a task should see.  ``current_ranking`` gives the ranking."""
    ratio, slide_ms = window_ratio(size_s, slide_s), seconds_to_us(slide_s) // 1000
    pane = pane_index(ts, slide_s)
    rows = (df.withWatermark(ts, f"{int(round((delay_s + lateness_s) * 1000))} milliseconds")
            .select(ts, key_col, F.pmod(F.xxhash64(key_col), F.lit(parts)).cast("bigint").alias("part"),
                    F.explode(F.sequence(pane + 1, pane + ratio)).alias("__end"))
            .withColumn("window_end_ms", F.col("__end") * F.lit(slide_ms)))
    key_type = df.schema[key_col].dataType
    out = StructType([_long("window_end_ms"), _long("part"), _long("rank_no"), StructField(key_col, key_type),
                      _long("cnt"), _long("version")])
    return rows.groupBy("window_end_ms", "part").transformWithState(
        RankingProcessor(key_col, key_type, n), out, "Update", "EventTime")


def current_ranking(changes: DataFrame, key_col: str, n: int) -> DataFrame:
    """``window_end_ms, <key>, cnt, rank_no`` after all ``changes``: the newest version of every rank."""
    newest = (changes.groupBy("window_end_ms", "part", "rank_no")
              .agg(F.max_by(F.struct(key_col, "cnt"), "version").alias("__r"))
              .select("window_end_ms", "__r.*"))
    return top_n(newest, "window_end_ms", key_col, n).select("window_end_ms", key_col, "cnt", "rank_no")


class FirstSeenProcessor(StatefulProcessor):
    """Whether a row is the first of its (window, user)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", StructType([_long("event_id")]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        ordered = sorted(((r["ts"], r["event_id"]) for r in rows), key=lambda r: (r[0], r[1] is not None, r[1]))
        new = not self.seen.exists()
        if new:
            self.seen.update((ordered[0][1],))
            self.handle.registerTimer(key[0])
        return iter([Row(window_end_ms=key[0], event_id=event, ts=at, first=int(new and i == 0))
                     for i, (at, event) in enumerate(ordered)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.seen.clear()
        return iter([])

    def close(self) -> None:
        pass


class RunningCountProcessor(StatefulProcessor):
    """Running sum of the first-seen flags of a window, in event order: one number of state."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.uv = handle.getValueState("uv", StructType([_long("uv")]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if self.uv.exists():
            uv = self.uv.get()[0]
        else:
            uv = 0
            self.handle.registerTimer(key[0])
        out = []
        ordered = sorted(((r["ts"], r["event_id"], r["first"]) for r in rows), key=lambda r: (r[0], r[1] is not None, r[1]))
        for _, event, first in ordered:
            uv += first
            out.append(Row(event_id=event, window_end_ms=key[0], uv=uv))
        self.uv.update((uv,))
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.uv.clear()
        return iter([])

    def close(self) -> None:
        pass


def stream_running_unique_visitors_exact(df: DataFrame, user: str = "user_id", ts: str = "ts", event_id: str = "event_id",
                                         window_s: float = 3600, delay_s: float = 0) -> DataFrame:
    """Distinct users so far in the tumbling window, a row per event (append mode): ``event_id,
    window_end_ms, uv``, the rows of the batch ``running_unique_visitors`` if events come in order.

    Two states: a flag per (window, user), spread over all tasks, and a counter per window
    fed by the flags.  A window's rows of one micro-batch pass through one task, which keeps
    a number; out-of-order events count when they arrive."""
    timed = df.withWatermark(ts, f"{int(round(delay_s * 1000))} milliseconds").select(
        tumbling_end_ms(ts, window_s).alias("window_end_ms"), F.col(user).alias("__user"),
        F.col(event_id).alias("event_id"), F.col(ts).alias("ts"))
    flags = StructType([_long("window_end_ms"), _long("event_id"), StructField("ts", timed.schema["ts"].dataType),
                        StructField("first", LongType())])
    first = timed.groupBy("window_end_ms", "__user").transformWithState(
        FirstSeenProcessor(), flags, "Append", "EventTime", eventTimeColumnName="ts")
    return first.groupBy("window_end_ms").transformWithState(
        RunningCountProcessor(), StructType([_long("event_id"), _long("window_end_ms"), _long("uv")]), "Append", "EventTime")
