"""Per-key event sequences: repeated login failures, order create/pay outcomes.

The original jobs keep per-key state and timers (or a pattern automaton).  In
batch the same answers come from the neighbours of each event in the key's
``(ts, id)`` order.  The neighbours are found with ``segmented_scan`` (a window
per key, cut in chunks for keys with very many events), so a key holding a large
share of the events is not sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.constants import (
    MSG_LOGIN_BURST,
    MSG_LOGIN_IMMEDIATE,
    MSG_LOGIN_PATTERN,
    MSG_NO_CREATE,
    MSG_NOT_PAYED,
    MSG_PATTERN_PAY,
    MSG_PATTERN_TIMEOUT,
    MSG_PAY_SUCCESS,
)
from tidemark.functions.time import floor_div, seconds_to_us
from tidemark.operators.scan import ScanAgg, chunks_for, segmented_scan


def _ms(c):
    return floor_div(c, 1000)


def _logins(logins: DataFrame, user: str, order_id: str) -> DataFrame:
    return logins.select(user, order_id, F.col("event_type").alias("__type"),
                         F.unix_micros("ts").alias("__ts"),
                         (F.col("event_type") == "fail").alias("__fail"))


def _neighbour(df: DataFrame, keys: list[str], order: list[str], name: str, value,
               kind: str, chunk_us: int | None, chunk_rows: int | None = None) -> DataFrame:
    """``kind`` = ``next`` / ``prev``: the key's following / preceding event."""
    return segmented_scan(df, keys, order, [ScanAgg(name, kind, value)],
                          chunks_for(df, "__ts", chunk_us, chunk_rows))


def login_fail_pattern(logins: DataFrame, gap_s: float = 2, user: str = "user_id",
                       order_id: str = "event_id", chunk_us: int | None = None,
                       chunk_rows: int | None = None) -> DataFrame:
    """Pattern ``fail`` then strictly next ``fail`` within ``gap_s`` (exclusive).

    Every such adjacent pair matches (overlapping pairs too).
    Output: ``user_id, first_fail_ms, last_fail_ms, warning_msg``.
    """
    base = _logins(logins, user, order_id)
    nxt = _neighbour(base, [user], ["__ts", order_id], "__n",
                     F.struct(F.col("__ts").alias("ts"), F.col("__fail").alias("fail")),
                     kind="next", chunk_us=chunk_us, chunk_rows=chunk_rows)
    hit = (F.col("__fail") & F.col("__n.fail")
           & (F.col("__n.ts") - F.col("__ts") < F.lit(seconds_to_us(gap_s))))
    return nxt.filter(hit).select(user, _ms(F.col("__ts")).alias("first_fail_ms"),
                                  _ms(F.col("__n.ts")).alias("last_fail_ms"),
                                  F.lit(MSG_LOGIN_PATTERN).alias("warning_msg"))


def login_fail_immediate(logins: DataFrame, gap_s: float = 2, user: str = "user_id",
                         order_id: str = "event_id", chunk_us: int | None = None) -> DataFrame:
    """Alert at a ``fail`` whose previous event of the user is a ``fail`` less
    than ``gap_s`` earlier; any success in between resets.
    Output: ``user_id, alert_event_id, first_fail_ms, last_fail_ms, warning_msg``."""
    base = _logins(logins, user, order_id)
    prv = _neighbour(base, [user], ["__ts", order_id], "__p",
                     F.struct(F.col("__ts").alias("ts"), F.col("__fail").alias("fail")),
                     kind="prev", chunk_us=chunk_us)
    hit = (F.col("__fail") & F.col("__p.fail")
           & (F.col("__ts") - F.col("__p.ts") < F.lit(seconds_to_us(gap_s))))
    return prv.filter(hit).select(user, F.col(order_id).alias("alert_event_id"),
                                  _ms(F.col("__p.ts")).alias("first_fail_ms"),
                                  _ms(F.col("__ts")).alias("last_fail_ms"),
                                  F.lit(MSG_LOGIN_IMMEDIATE).alias("warning_msg"))


def login_fail_burst(logins: DataFrame, min_fails: int = 2, window_s: float = 2,
                     user: str = "user_id", order_id: str = "event_id",
                     chunk_us: int | None = None) -> DataFrame:
    """Timer detector: the first fail of a run of fails starts a timer of
    ``window_s``; a success before it fires cancels the run; when it fires,
    alert if at least ``min_fails`` fails fell in ``[t0, t0 + window_s]``.
    At most one alert per run (the original does not re-arm after firing).

    A run starts at a fail whose previous event is none.  Its start is carried down
    to the later events of the user by a second scan over the same rows, so one
    aggregation per run start gives the fails in time and the closing success.
    Output: ``user_id, first_fail_ms, last_fail_ms, fail_count, warning_msg``.
    """
    w_us = F.lit(seconds_to_us(window_s))
    base = _logins(logins, user, order_id).select(user, order_id, "__ts", "__fail")
    order, chunks = ["__ts", order_id], chunks_for(base, "__ts", chunk_us)
    prev = segmented_scan(base, [user], order, [ScanAgg("__p", "prev", F.col("__fail"))], chunks)
    start = F.when(F.col("__fail") & ~F.coalesce("__p", F.lit(False)),
                   F.struct(F.col("__ts").alias("ts"), F.col(order_id).alias("id")))
    runs = segmented_scan(prev, [user], order, [ScanAgg("__s", "nearest", start)], chunks, inclusive=True)
    in_time = F.col("__fail") & (F.col("__ts") <= F.col("__s.ts") + w_us)
    found = (runs.filter(F.col("__s").isNotNull())
             .select(user, F.col("__s.ts").alias("__t0"), F.col("__s.id").alias("__id0"),
                     F.when(in_time, F.col("__ts")).alias("__hit"),
                     F.when(~F.col("__fail"), F.col("__ts")).alias("__done"))
             .groupBy(user, "__t0", "__id0")
             .agg(F.count("__hit").alias("fail_count"), F.max("__hit").alias("__last"), F.min("__done").alias("__close")))
    alerts = found.filter((F.col("fail_count") >= min_fails)
                          & (F.col("__close").isNull() | (F.col("__close") > F.col("__t0") + w_us)))
    return alerts.select(user, _ms(F.col("__t0")).alias("first_fail_ms"), _ms(F.col("__last")).alias("last_fail_ms"),
                         "fail_count", F.format_string(MSG_LOGIN_BURST, F.col("fail_count")).alias("warning_msg"))


def _orders(order_events: DataFrame, key: str, order_id: str) -> DataFrame:
    """The creates and pays (other kinds of events decide nothing) with ``__ord = 2 * ts + is_pay``: time order, creates before
    pays at equal times (one integral column, so scans pack their order key)."""
    is_pay = F.col("event") == "pay"
    return order_events.filter(F.col("event").isin("create", "pay")).select(key, order_id, F.col("event").alias("__event"),
                               F.unix_micros("ts").alias("__ts"), is_pay.alias("__is_pay"),
                               (F.unix_micros("ts") * 2 + is_pay.cast("bigint")).alias("__ord"))


_ORDER = ["__ord"]


def order_timeout(order_events: DataFrame, limit_s: float = 15 * 60, key: str = "order_id",
                  order_id: str = "event_id", chunk_us: int | None = None) -> DataFrame:
    """Pattern ``create`` followed by ``pay`` (any events between) within
    ``limit_s`` (exclusive); each create is matched with the first later pay.
    Output per create: ``order_id, create_event_id, create_ms, result,
    result_ms`` with result ``pay`` (result_ms = pay time) or ``timeout``
    (result_ms = create time + limit)."""
    base = _orders(order_events, key, order_id)
    nxt = segmented_scan(base, [key], [*_ORDER, order_id],
                         [ScanAgg("__next_pay", "nearest",
                                  F.when(F.col("__event") == "pay", F.col("__ts")))],
                         chunks_for(base, "__ts", chunk_us), reverse=True)
    in_time = (F.col("__next_pay") - F.col("__ts")) < F.lit(seconds_to_us(limit_s))
    in_time = F.coalesce(in_time, F.lit(False))
    limit_ms = F.lit(seconds_to_us(limit_s) // 1000)
    return (nxt.filter(F.col("__event") == "create")
            .select(key, F.col(order_id).alias("create_event_id"),
                    _ms(F.col("__ts")).alias("create_ms"),
                    F.when(in_time, F.lit(MSG_PATTERN_PAY)).otherwise(F.lit("timeout")).alias("result"),
                    F.when(in_time, _ms(F.col("__next_pay")))
                    .otherwise(_ms(F.col("__ts")) + limit_ms).alias("result_ms")))


def order_timeout_messages(result: DataFrame) -> DataFrame:
    """The original's text form: ``pay`` / ``pay timeout <ms>``."""
    return result.withColumn(
        "result_msg",
        F.when(F.col("result") == MSG_PATTERN_PAY, F.lit(MSG_PATTERN_PAY))
        .otherwise(F.concat_ws(" ", F.lit(MSG_PATTERN_TIMEOUT), F.col("result_ms").cast("string"))))


def order_pay_match(order_events: DataFrame, limit_s: float = 15 * 60, key: str = "order_id",
                    order_id: str = "event_id", chunk_us: int | None = None) -> DataFrame:
    """Create/pay state machine with three outcomes, in ``(ts, create first, id)`` order
    of the creates and pays (order events of other kinds are as if they were not there):

    * a create whose next event is a pay at most ``limit_s`` later -> ``pay success``;
    * a create whose next event is another create at most ``limit_s`` later -> no
      row (the original's single flag merges them);
    * any other create -> ``create but not payed``;
    * a pay whose previous event is not a create at most ``limit_s`` earlier ->
      ``payed but not found create`` (so a pay after the deadline gives both rows).

    Output: ``order_id, create_ms, pay_ms, result``.
    """
    base = _orders(order_events, key, order_id)
    order = [*_ORDER, order_id]
    chunk = chunks_for(base, "__ts", chunk_us)
    nb = F.struct(F.col("__ts").alias("ts"), F.col("__is_pay").alias("pay"))
    s = segmented_scan(base, [key], order, [ScanAgg("__n", "next", nb), ScanAgg("__p", "prev", nb)],
                       chunk)
    lim = F.lit(seconds_to_us(limit_s))
    is_create = F.col("__event") == "create"
    next_close = F.coalesce(F.col("__n.ts") - F.col("__ts") <= lim, F.lit(False))
    paid = is_create & next_close & F.col("__n.pay")
    prev_create = F.coalesce(~F.col("__p.pay") & (F.col("__ts") - F.col("__p.ts") <= lim),
                             F.lit(False))
    result = (F.when(paid, F.lit(MSG_PAY_SUCCESS))
              .when(is_create & ~next_close, F.lit(MSG_NOT_PAYED))
              .when(~is_create & ~prev_create, F.lit(MSG_NO_CREATE)))
    out = s.select(key, "__ts", "__n", is_create.alias("__c"), result.alias("result"))
    return (out.filter(F.col("result").isNotNull())
            .select(key,
                    F.when(F.col("__c"), _ms(F.col("__ts"))).alias("create_ms"),
                    F.when(F.col("result") == MSG_PAY_SUCCESS, _ms(F.col("__n.ts")))
                    .when(~F.col("__c"), _ms(F.col("__ts"))).alias("pay_ms"),
                    "result"))
