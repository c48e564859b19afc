"""Stateful stream processors (``transformWithState``) for the sequence operators.

Every processor here follows one rule so that a stream gives the same rows as
the batch operator, however its input is cut into micro-batches:

* incoming rows of a key are appended to a list state and an event-time timer
  is set at the earliest buffered time;
* when the watermark passes, the buffered rows older than the watermark are
  *replayed in (ts, tie-break, id) order* through the key's state machine, and
  deadlines (``t + limit``) are resolved only when every row that could still
  decide them is older than the watermark;
* rows behind the watermark are dropped before the processor by Spark, which counts
  them in the progress metric ``numRowsDroppedByWatermark``; ``stream_split_late``
  keeps them whole.

The per-key state machines are small: they see one key's events in order and
keep O(1) values (the order-timeout machine keeps the creates still waiting,
bounded by the creates of one ``limit`` interval).  All events of a key pass
through one task of a micro-batch, and its buffer holds the events of one
watermark delay: that is how Spark's keyed state works, and a key with a large share
of a stream needs the batch form or a finer key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tidemark.constants import (
    LOCAL_DAY_OFFSET_S,
    MSG_LOGIN_BURST,
    MSG_LOGIN_IMMEDIATE,
    MSG_LOGIN_PATTERN,
    MSG_NO_CREATE,
    MSG_NOT_PAYED,
    MSG_PATTERN_PAY,
    MSG_PAY_SUCCESS,
)

_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def _to_us(ts: Any) -> int:
    """Epoch microseconds of a TIMESTAMP value handed to a Python worker.

    PySpark renders TIMESTAMP as a naive datetime in the worker's local time
    zone; ``astimezone`` reads a naive value as local time, which inverts
    that, so the result does not depend on the executors' zone.
    """
    if isinstance(ts, dt.datetime):
        if ts.tzinfo is None:
            ts = ts.astimezone(dt.timezone.utc)
        delta = ts - _EPOCH
        return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds
    return int(ts)


def _ms(us: int) -> int:
    return us // 1000


BUFFER_SCHEMA = StructType([
    StructField("ts_us", LongType()), StructField("rank", LongType()), StructField("id", LongType()),
    StructField("kind", StringType()), StructField("aux", LongType()), StructField("text", StringType()),
])


def _field(name: str, dtype=LongType()) -> StructField:
    return StructField(name, dtype, True)


class Machine:
    """A per-key state machine over events in order."""

    state_schema: StructType
    output_schema: StructType

    def initial(self) -> dict:
        return {f.name: None for f in self.state_schema.fields}

    def step(self, key: Any, st: dict, ev: Row) -> list[tuple]:
        raise NotImplementedError

    def flush(self, key: Any, st: dict, wm_us: int) -> tuple[list[tuple], int | None]:
        """Resolve deadlines below the watermark; return rows and the next deadline."""
        return [], None

    def to_buffer(self, row: Row) -> tuple:
        raise NotImplementedError

    def idle(self, st: dict) -> bool:
        """True when the key's state can no longer affect any output (it is
        then dropped, so keys that go quiet do not keep state)."""
        return False


class ReplayProcessor(StatefulProcessor):
    """Buffer per key, replay in order below the watermark, resolve deadlines."""

    def __init__(self, machine: Machine):
        self.machine = machine

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buf = handle.getListState("buffer", BUFFER_SCHEMA)
        self.state = handle.getValueState("machine", self.machine.state_schema)

    def _load_state(self) -> dict:
        if self.state.exists():
            vals = self.state.get()
            return dict(zip([f.name for f in self.machine.state_schema.fields], vals))
        return self.machine.initial()

    def _arm(self, at_us: int) -> None:
        self.handle.registerTimer(at_us // 1000 + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = [self.machine.to_buffer(r) for r in rows]
        if new:
            self.buf.appendList(new)
            self._arm(min(b[0] for b in new))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        wm_us = timerValues.getCurrentWatermarkInMs() * 1000
        buffered = list(self.buf.get()) if self.buf.exists() else []
        ready = sorted((b for b in buffered if b[0] < wm_us), key=lambda b: (b[0], b[1], b[2]))
        rest = [tuple(b) for b in buffered if b[0] >= wm_us]
        st = self._load_state()
        out: list[tuple] = []
        k = key[0] if isinstance(key, tuple) and len(key) == 1 else key
        for b in ready:
            out += self.machine.step(k, st, b)
        flushed, deadline = self.machine.flush(k, st, wm_us)
        out += flushed
        idle = self.machine.idle(st) and not rest
        if idle:
            # nothing left that can affect output: keep no state for the key
            self.state.clear()
        else:
            self.state.update(tuple(st[f.name] for f in self.machine.state_schema.fields))
        if rest:
            self.buf.put(rest)
            self._arm(min(b[0] for b in rest))
        else:
            self.buf.clear()
        if deadline is not None:
            self._arm(deadline)
        names = self.machine.output_schema.fieldNames()
        return iter([Row(**dict(zip(names, o))) for o in out])

    def close(self) -> None:
        pass


# --------------------------------------------------------------------------- login failures


class LoginPairMachine(Machine):
    """fail immediately followed (per user) by fail within ``gap`` (exclusive)."""

    state_schema = StructType([_field("prev_ts"), _field("prev_fail", BooleanType())])

    def __init__(self, gap_s: float = 2, immediate: bool = False):
        self.gap_us = int(round(gap_s * 1_000_000))
        self.immediate = immediate
        if immediate:
            self.output_schema = StructType([_field("user_id"), _field("alert_event_id"),
                                             _field("first_fail_ms"), _field("last_fail_ms"),
                                             _field("warning_msg", StringType())])
        else:
            self.output_schema = StructType([_field("user_id"), _field("first_fail_ms"),
                                             _field("last_fail_ms"), _field("warning_msg", StringType())])

    def to_buffer(self, r: Row) -> tuple:
        return (_to_us(r["ts"]), 0, r["event_id"], r["event_type"], None, None)

    def step(self, key, st, ev) -> list[tuple]:
        ts, _, eid, kind = ev[0], ev[1], ev[2], ev[3]
        out = []
        if kind == "fail" and st["prev_fail"] and ts - st["prev_ts"] < self.gap_us:
            if self.immediate:
                out.append((key, eid, _ms(st["prev_ts"]), _ms(ts), MSG_LOGIN_IMMEDIATE))
            else:
                out.append((key, _ms(st["prev_ts"]), _ms(ts), MSG_LOGIN_PATTERN))
        st["prev_ts"], st["prev_fail"] = ts, kind == "fail"
        return out

    def flush(self, key, st, wm_us):
        # a previous event more than ``gap`` before the watermark can pair with nothing
        if st["prev_ts"] is not None and st["prev_ts"] + self.gap_us < wm_us:
            st["prev_ts"], st["prev_fail"] = None, None
            return [], None
        return [], (st["prev_ts"] + self.gap_us if st["prev_ts"] is not None else None)

    def idle(self, st) -> bool:
        return st["prev_ts"] is None


class LoginBurstMachine(Machine):
    """First fail of a run arms a deadline; a success by then cancels; at the
    deadline alert if at least ``min_fails`` fails fell in ``[t0, t0 + window]``."""

    state_schema = StructType([_field("t0"), _field("cnt"), _field("last"),
                               _field("resolved", BooleanType())])
    output_schema = StructType([_field("user_id"), _field("first_fail_ms"), _field("last_fail_ms"),
                                _field("fail_count"), _field("warning_msg", StringType())])

    def __init__(self, min_fails: int = 2, window_s: float = 2):
        self.n = min_fails
        self.w_us = int(round(window_s * 1_000_000))

    def to_buffer(self, r: Row) -> tuple:
        return (_to_us(r["ts"]), 0, r["event_id"], r["event_type"], None, None)

    def _resolve(self, key, st) -> list[tuple]:
        st["resolved"] = True
        if st["cnt"] >= self.n:
            return [(key, _ms(st["t0"]), _ms(st["last"]), st["cnt"], MSG_LOGIN_BURST % st["cnt"])]
        return []

    def step(self, key, st, ev) -> list[tuple]:
        ts, kind = ev[0], ev[3]
        out = []
        if kind == "fail":
            if st["t0"] is None:
                st.update(t0=ts, cnt=1, last=ts, resolved=False)
            elif not st["resolved"] and ts <= st["t0"] + self.w_us:
                st["cnt"] += 1
                st["last"] = ts
        else:
            if st["t0"] is not None and not st["resolved"] and ts > st["t0"] + self.w_us:
                out += self._resolve(key, st)
            st.update(t0=None, cnt=None, last=None, resolved=None)
        return out

    def flush(self, key, st, wm_us):
        if st["t0"] is None or st["resolved"]:
            return [], None
        if st["t0"] + self.w_us < wm_us:
            return self._resolve(key, st), None
        return [], st["t0"] + self.w_us

    def idle(self, st) -> bool:
        # an alerted run is remembered until its success, or its next fail would start a new one
        return st["t0"] is None


# --------------------------------------------------------------------------- orders


def _order_buffer(r: Row) -> tuple:
    return (_to_us(r["ts"]), 1 if r["event"] == "pay" else 0, r["event_id"], r["event"], None, None)


class OrderPayMachine(Machine):
    """create/pay outcomes: next event decides a create; previous decides a pay."""

    state_schema = StructType([_field("last_ts"), _field("last_kind", StringType()),
                               _field("pending", BooleanType())])
    output_schema = StructType([_field("order_id"), _field("create_ms"), _field("pay_ms"),
                                _field("result", StringType())])

    def __init__(self, limit_s: float = 15 * 60):
        self.lim = int(round(limit_s * 1_000_000))

    to_buffer = staticmethod(_order_buffer)

    def step(self, key, st, ev) -> list[tuple]:
        ts, kind = ev[0], ev[3]
        out = []
        if kind not in ("create", "pay"):     # decides nothing, as in the batch form
            return out
        close = st["last_ts"] is not None and ts - st["last_ts"] <= self.lim
        if st["pending"]:
            if close and kind == "pay":
                out.append((key, _ms(st["last_ts"]), _ms(ts), MSG_PAY_SUCCESS))
            elif not close:
                out.append((key, _ms(st["last_ts"]), None, MSG_NOT_PAYED))
            # a close create supersedes the pending one: no row
        if kind == "pay" and not (st["last_kind"] == "create" and close):
            out.append((key, None, _ms(ts), MSG_NO_CREATE))
        st.update(last_ts=ts, last_kind=kind, pending=(kind == "create"))
        return out

    def flush(self, key, st, wm_us):
        if st["last_ts"] is None:
            return [], None
        if st["last_ts"] + self.lim < wm_us:
            out = [(key, _ms(st["last_ts"]), None, MSG_NOT_PAYED)] if st["pending"] else []
            # beyond the limit the last event decides nothing more
            st.update(last_ts=None, last_kind=None, pending=None)
            return out, None
        return [], st["last_ts"] + self.lim

    def idle(self, st) -> bool:
        return st["last_ts"] is None


class OrderTimeoutMachine(Machine):
    """Each create waits for the first later pay within ``limit`` (exclusive)."""

    # creates still waiting, in order (bounded by one limit interval)
    state_schema = StructType([StructField("times", ArrayType(LongType())), StructField("ids", ArrayType(LongType()))])
    output_schema = StructType([_field("order_id"), _field("create_event_id"), _field("create_ms"),
                                _field("result", StringType()), _field("result_ms")])

    def __init__(self, limit_s: float = 15 * 60):
        self.lim = int(round(limit_s * 1_000_000))

    to_buffer = staticmethod(_order_buffer)

    def _out(self, key, create_us: int, create_id: int, pay_us: int | None) -> tuple:
        if pay_us is not None and pay_us - create_us < self.lim:
            return (key, create_id, _ms(create_us), MSG_PATTERN_PAY, _ms(pay_us))
        return (key, create_id, _ms(create_us), "timeout", _ms(create_us) + self.lim // 1000)

    def step(self, key, st, ev) -> list[tuple]:
        ts, kind, eid = ev[0], ev[3], ev[2]
        if st["times"] is None:
            st.update(times=[], ids=[])
        if kind == "create":
            st["times"].append(ts)
            st["ids"].append(eid)
            return []
        out = [self._out(key, c, i, ts) for c, i in zip(st["times"], st["ids"])]
        st.update(times=[], ids=[])
        return out

    def flush(self, key, st, wm_us):
        times, ids = st["times"] or [], st["ids"] or []
        done = next((k for k, c in enumerate(times) if c + self.lim > wm_us), len(times))   # times ascend
        out = [self._out(key, c, i, None) for c, i in zip(times[:done], ids[:done])]
        st.update(times=list(times[done:]), ids=list(ids[done:]))
        return out, (times[done] + self.lim if done < len(times) else None)

    def idle(self, st) -> bool:
        return not st["times"]


# --------------------------------------------------------------------------- clicks


class ClickLimitMachine(Machine):
    """Per (user, ad): pass the first ``max_clicks`` clicks of each local day,
    warn once at the next one, drop the rest."""

    state_schema = StructType([_field("day"), _field("cnt")])
    output_schema = StructType([_field("user_id"), _field("ad_id"), _field("kind", StringType()),
                                _field("event_id"), _field("province", StringType()),
                                _field("ts_ms"), _field("day_start_ms")])

    def __init__(self, max_clicks: int = 100, day_offset_s: int = LOCAL_DAY_OFFSET_S):
        self.n = max_clicks
        self.off_us = day_offset_s * 1_000_000

    def to_buffer(self, r: Row) -> tuple:
        return (_to_us(r["ts"]), 0, r["event_id"], "click", None, r["province"])

    def step(self, key, st, ev) -> list[tuple]:
        ts, eid, province = ev[0], ev[2], ev[5]
        user, ad = key
        day = (ts + self.off_us) // 86_400_000_000
        if st["day"] != day:
            st.update(day=day, cnt=0)
        st["cnt"] += 1
        day_start = day * 86_400_000 - self.off_us // 1000
        if st["cnt"] <= self.n:
            return [(user, ad, "pass", eid, province, _ms(ts), day_start)]
        if st["cnt"] == self.n + 1:
            return [(user, ad, "warning", eid, province, _ms(ts), day_start)]
        return []

    def flush(self, key, st, wm_us):
        # the counter resets at local midnight (the original's reset timer)
        if st["day"] is None:
            return [], None
        day_end = (st["day"] + 1) * 86_400_000_000 - self.off_us
        if day_end <= wm_us:
            st.update(day=None, cnt=None)
            return [], None
        return [], day_end

    def idle(self, st) -> bool:
        return st["day"] is None


# --------------------------------------------------------------------------- tx matching


class TxMatchMachine(Machine):
    """One slot per key: a pay waits for the next event; a receipt at most ``wait`` later takes
    it, anything else leaves it unmatched.  Rows without a key match nothing.  The
    records travel as JSON."""

    state_schema = StructType([_field("pay_ts"), _field("pay_id"), _field("pay", StringType())])
    output_schema = StructType([_field("tx_id"), _field("kind", StringType()), _field("pay_event_id"),
                                _field("receipt_event_id"), _field("pay_ms"), _field("receipt_ms"),
                                _field("pay", StringType()), _field("receipt", StringType())])

    def __init__(self, wait_s: float = 3):
        self.wait = int(round(wait_s * 1_000_000))

    def to_buffer(self, r: Row) -> tuple:
        return (_to_us(r["ts"]), 0 if r["side"] == "pay" else 1, r["event_id"], r["side"], None, r["record"])

    def _unmatched(self, key, st) -> list[tuple]:
        """The waiting pay, if there is one; the slot is free afterwards."""
        if st["pay_ts"] is None:
            return []
        out = [(key, "order_only", st["pay_id"], None, _ms(st["pay_ts"]), None, st["pay"], None)]
        st.update(pay_ts=None, pay_id=None, pay=None)
        return out

    def step(self, key, st, ev) -> list[tuple]:
        ts, eid, side, record = ev[0], ev[2], ev[3], ev[5]
        if side == "receipt" and st["pay_ts"] is not None and ts - st["pay_ts"] <= self.wait:
            out = [(key, "matched", st["pay_id"], eid, _ms(st["pay_ts"]), _ms(ts), st["pay"], record)]
            st.update(pay_ts=None, pay_id=None, pay=None)
            return out
        out = self._unmatched(key, st)
        if side == "receipt":
            return [*out, (key, "receipt_only", None, eid, None, _ms(ts), None, record)]
        st.update(pay_ts=ts, pay_id=eid, pay=record)
        return [*out, *self._unmatched(key, st)] if key is None else out

    def flush(self, key, st, wm_us):
        if st["pay_ts"] is not None and st["pay_ts"] + self.wait < wm_us:   # no receipt can come in time
            return self._unmatched(key, st), None
        return [], (st["pay_ts"] + self.wait if st["pay_ts"] is not None else None)

    def idle(self, st) -> bool:
        return st["pay_ts"] is None


# --------------------------------------------------------------------------- wiring


def run_machine(df: DataFrame, keys: list[str], machine: Machine,
                watermark_delay_s: float = 0, ts: str = "ts") -> DataFrame:
    """Apply ``machine`` per key to a streaming (or batch) frame with event time ``ts``."""
    src = df.withWatermark(ts, f"{int(watermark_delay_s * 1000)} milliseconds") if df.isStreaming else df
    return src.groupBy(*keys).transformWithState(
        ReplayProcessor(machine), machine.output_schema, "Append", "EventTime")


def stream_login_fail_pattern(logins: DataFrame, gap_s: float = 2, delay_s: float = 3) -> DataFrame:
    return run_machine(logins, ["user_id"], LoginPairMachine(gap_s), delay_s)


def stream_login_fail_immediate(logins: DataFrame, gap_s: float = 2, delay_s: float = 3) -> DataFrame:
    return run_machine(logins, ["user_id"], LoginPairMachine(gap_s, immediate=True), delay_s)


def stream_login_fail_burst(logins: DataFrame, min_fails: int = 2, window_s: float = 2,
                            delay_s: float = 3) -> DataFrame:
    return run_machine(logins, ["user_id"], LoginBurstMachine(min_fails, window_s), delay_s)


def stream_order_pay_match(order_events: DataFrame, limit_s: float = 15 * 60,
                           delay_s: float = 0) -> DataFrame:
    return run_machine(order_events, ["order_id"], OrderPayMachine(limit_s), delay_s)


def stream_order_timeout(order_events: DataFrame, limit_s: float = 15 * 60,
                         delay_s: float = 0) -> DataFrame:
    return run_machine(order_events, ["order_id"], OrderTimeoutMachine(limit_s), delay_s)


def stream_ad_click_filter(clicks: DataFrame, max_clicks: int = 100,
                           day_offset_s: int = LOCAL_DAY_OFFSET_S, delay_s: float = 0) -> DataFrame:
    """Tagged rows: ``kind`` = ``pass`` (forwarded clicks) or ``warning``."""
    return run_machine(clicks, ["user_id", "ad_id"], ClickLimitMachine(max_clicks, day_offset_s),
                       delay_s)


def stream_tx_match(pays: DataFrame, receipts: DataFrame, wait_s: float = 3,
                    delay_s: float = 0, pay_filter: Column | None = None) -> DataFrame:
    """Union the two streams (tagged by side) and match per tx id; columns as in the batch form,
    ``pay`` and ``receipt`` being the whole records."""
    if pay_filter is not None:
        pays = pays.filter(pay_filter)

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select("tx_id", "event_id", "ts", F.lit(name).alias("side"),
                         F.to_json(F.struct(*df.columns), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).alias("record"))
    found = run_machine(side(pays, "pay").unionByName(side(receipts, "receipt")), ["tx_id"], TxMatchMachine(wait_s), delay_s)
    return found.withColumns({c: F.from_json(c, df.schema, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
                              for c, df in (("pay", pays), ("receipt", receipts))})


def read_click_sink(spark, path: str) -> DataFrame:
    """The pass rows the click-filter stream wrote to a parquet sink, as a
    stream with an event-time column ``ts`` (from the millisecond times)."""
    schema = ClickLimitMachine(1).output_schema
    return (spark.readStream.schema(schema).parquet(path)
            .filter(F.col("kind") == "pass")
            .withColumn("ts", F.timestamp_millis("ts_ms")))


def stream_ad_clicks_by_province(passed: DataFrame, panes_path: str, out_path: str, name: str, size_s: float = 86400,
                                 slide_s: float = 5, delay_s: float = 0, **sink) -> StreamingQuery:
    """Second stage of the click job: counts per province and sliding window
    over the passed clicks, read back from the filter's sink
    (``read_click_sink``) in a second query; 17,280 windows per click, so from
    pane counts (``sinks.sliding_counts_each_batch``).

    The filter emits a click only once the watermark has passed it, so it
    cannot feed an event-time aggregation in the same query; a written table
    between two queries gives the second its own watermark.  Pass rows carry
    millisecond times; windows align on whole seconds, so no click changes pane.
    """
    from tidemark.streaming.sinks import sliding_counts_each_batch

    return sliding_counts_each_batch(passed, ["province"], size_s, slide_s, panes_path, out_path, name,
                                     delay_s=delay_s, **sink)
