"""Random small inputs: each operator equals a plain-Python brute force.

Timestamps are whole seconds in a short span so that equal times and limits
hit exactly happen often; the scan chunk width is a few seconds so that every
cross-chunk path of ``segmented_scan`` is taken.
"""

import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark import operators as O

T0 = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
MS0 = int(T0.timestamp() * 1000)
CHUNK = 7 * 1_000_000
SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

events = st.lists(st.tuples(st.integers(0, 2), st.sampled_from(["a", "b"]), st.integers(0, 40)),
                  min_size=0, max_size=30)


def frame(spark, recs, key, kind):
    data = [(i, k, t, T0 + dt.timedelta(seconds=s)) for i, (k, t, s) in enumerate(recs)]
    return spark.createDataFrame(data, f"event_id long, {key} long, {kind} string, ts timestamp")


def ordered(recs, pay_first=False):
    """Per key: (ts, [tie], id, kind) sorted the way the operators order rows."""
    by = defaultdict(list)
    for i, (k, t, s) in enumerate(recs):
        tie = (1 if t == "pay" else 0) if pay_first else 0
        by[k].append((s, tie, i, t))
    return {k: sorted(v) for k, v in by.items()}


@SETTINGS
@given(events)
def test_login_pairs(spark, recs):
    recs = [(k, "fail" if t == "a" else "success", s) for k, t, s in recs]
    df = frame(spark, recs, "user_id", "event_type")
    expect = []
    for k, seq in ordered(recs).items():
        for (s1, _, _, t1), (s2, _, i2, t2) in zip(seq, seq[1:]):
            if t1 == t2 == "fail" and s2 - s1 < 5:
                expect.append((k, MS0 + s1 * 1000, MS0 + s2 * 1000))
    cols = ["user_id", "first_fail_ms", "last_fail_ms"]
    assert rows(O.login_fail_pattern(df, 5, chunk_us=CHUNK), cols) == sorted(expect)
    assert rows(O.login_fail_immediate(df, 5, chunk_us=CHUNK), cols) == sorted(expect)


@SETTINGS
@given(events)
def test_login_burst(spark, recs):
    recs = [(k, "fail" if t == "a" else "success", s) for k, t, s in recs]
    df = frame(spark, recs, "user_id", "event_type")
    w, n = 6, 2
    expect = []
    for k, seq in ordered(recs).items():
        run = []
        for s, _, _, t in seq + [(None, 0, 0, "end")]:
            if t == "fail":
                run.append(s)
                continue
            if run:
                t0 = run[0]
                hits = [x for x in run if x <= t0 + w]
                if (s is None or s > t0 + w) and len(hits) >= n:
                    expect.append((k, MS0 + t0 * 1000, MS0 + max(hits) * 1000, len(hits)))
            run = []
    got = rows(O.login_fail_burst(df, n, w, chunk_us=CHUNK),
               ["user_id", "first_fail_ms", "last_fail_ms", "fail_count"])
    assert got == sorted(expect)


@SETTINGS
@given(events)
def test_order_outcomes(spark, recs):
    recs = [(k, "create" if t == "a" else "pay", s) for k, t, s in recs]
    df = frame(spark, recs, "order_id", "event")
    lim = 6
    match, timeout = [], []
    for k, seq in ordered(recs, pay_first=True).items():
        for j, (s, _, i, t) in enumerate(seq):
            if t == "create":
                nxt = seq[j + 1] if j + 1 < len(seq) else None
                if nxt and nxt[0] - s <= lim:
                    if nxt[3] == "pay":
                        match.append((k, MS0 + s * 1000, MS0 + nxt[0] * 1000, "pay success"))
                else:
                    match.append((k, MS0 + s * 1000, None, "create but not payed"))
                pay = next((p for p in seq[j + 1:] if p[3] == "pay"), None)
                if pay and pay[0] - s < lim:
                    timeout.append((k, i, "pay", MS0 + pay[0] * 1000))
                else:
                    timeout.append((k, i, "timeout", MS0 + (s + lim) * 1000))
            else:
                prv = seq[j - 1] if j else None
                if not (prv and prv[3] == "create" and s - prv[0] <= lim):
                    match.append((k, None, MS0 + s * 1000, "payed but not found create"))
    got = rows(O.order_pay_match(df, lim, chunk_us=CHUNK), ["order_id", "create_ms", "pay_ms", "result"])
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    assert got == sorted(match, key=key)
    got = rows(O.order_timeout(df, lim, chunk_us=CHUNK), ["order_id", "create_event_id", "result", "result_ms"])
    assert got == sorted(timeout)


sides = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 30)), min_size=0, max_size=15)


def side(spark, recs, base):
    return spark.createDataFrame(
        [(base + i, k, T0 + dt.timedelta(seconds=s)) for i, (k, s) in enumerate(recs)],
        "event_id long, tx_id long, ts timestamp")


@SETTINGS
@given(sides, sides)
def test_tx_joins(spark, pays, recs):
    p, r = side(spark, pays, 0), side(spark, recs, 1000)
    expect = sorted((i, 1000 + j) for i, (kp, sp) in enumerate(pays) for j, (kr, sr) in enumerate(recs)
                    if kp == kr and sp - 3 <= sr <= sp + 5)
    assert rows(O.tx_interval_join(p, r, 3, 5), ["pay_event_id", "receipt_event_id"]) == expect
    wait = 4
    out = []
    for k in {x[0] for x in pays} | {x[0] for x in recs}:
        seq = sorted([(s, 0, i) for i, (kk, s) in enumerate(pays) if kk == k]
                     + [(s, 1, 1000 + j) for j, (kk, s) in enumerate(recs) if kk == k])
        slot = None                                    # the one waiting pay
        for s, is_receipt, i in seq:
            if is_receipt and slot and s - slot[0] <= wait:
                out.append(("matched", slot[1], i))
                slot = None
                continue
            if slot:
                out.append(("order_only", slot[1], None))
            slot = None if is_receipt else (s, i)
            if is_receipt:
                out.append(("receipt_only", None, i))
        if slot:
            out.append(("order_only", slot[1], None))
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    got = rows(O.tx_match(p, r, wait, chunk_us=CHUNK), ["kind", "pay_event_id", "receipt_event_id"])
    assert got == sorted(out, key=key)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 4), st.integers(0, 3 * 86400)),
                min_size=0, max_size=25))
def test_click_limit(spark, recs):
    df = spark.createDataFrame(
        [(i, u, a, T0 + dt.timedelta(seconds=s)) for i, (u, a, s) in enumerate(recs)],
        "event_id long, user_id long, ad_id long, ts timestamp")
    n = 2
    groups = defaultdict(list)
    for i, (u, a, s) in enumerate(recs):
        groups[(u, a, (s + 8 * 3600) // 86400)].append((s, i))
    passed, warned = [], []
    for g in groups.values():
        g.sort()
        passed += [i for _, i in g[:n]]
        if len(g) > n:
            warned.append(g[n][1])
    assert [r[0] for r in rows(O.ad_click_filter(df, n), ["event_id"])] == sorted(passed)
    assert [r[0] for r in rows(O.ad_click_warnings(df, n), ["event_id"])] == sorted(warned)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 600)), min_size=1, max_size=30),
       st.sampled_from([(60, 20), (120, 30), (90, 90), (300, 10)]))
def test_sliding_counts_brute_force(spark, recs, shape):
    size, slide = shape
    df = spark.createDataFrame([(i, k, T0 + dt.timedelta(seconds=s)) for i, (k, s) in enumerate(recs)],
                               "event_id long, k long, ts timestamp")
    base = int(T0.timestamp())
    counts = defaultdict(int)
    for k, s in recs:
        t = base + s
        end = (t // slide + 1) * slide
        while end - size <= t:
            counts[(k, end * 1000)] += 1
            end += slide
    expect = sorted((k, e, c) for (k, e), c in counts.items())
    for method in ("expand", "delta"):
        got = rows(O.sliding_count(df, ["k"], "ts", size, slide, method=method),
                   ["k", "window_end_ms", "cnt"])
        assert got == expect, method


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 7200), st.integers(0, 4000)), min_size=1, max_size=30),
       st.sampled_from([None, 200]))
def test_split_late_brute_force(spark, recs, slide):
    df = spark.createDataFrame(
        [(i, T0 + dt.timedelta(seconds=s), (int(T0.timestamp()) + s + d) * 1_000_000)
         for i, (s, d) in enumerate(recs)], "event_id long, ts timestamp, arr long")
    base = int(T0.timestamp())
    order = sorted(range(len(recs)), key=lambda i: (base + recs[i][0] + recs[i][1], i))
    late, mx = [], None
    for i in order:
        ts = base + recs[i][0]
        step = slide or 600
        end = (ts // step) * step + 600            # end of the last window holding ts
        if mx is not None and end + 30 <= mx - 60:
            late.append(i)
        mx = ts if mx is None else max(mx, ts)
    out = O.split_late(df, F.col("arr"), "ts", "event_id", 600, slide, 60, 30, chunk_us=CHUNK * 100)
    assert [r[0] for r in rows(out.filter("is_late"), ["event_id"])] == sorted(late)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 200), st.integers(0, 7200)), min_size=1, max_size=40))
def test_salted_equals_plain_and_bitmap_bounds(spark, recs):
    df = spark.createDataFrame(
        [(i, u, T0 + dt.timedelta(seconds=s)) for i, (u, s) in enumerate(recs)],
        "event_id long, user_id long, ts timestamp")
    assert rows(O.page_views_salted(df, "ts", 1800, 300)) == rows(O.page_views(df, "ts", 1800, 300))
    exact = {r.window_end_ms: r.uv for r in
             df.groupBy(((F.floor(F.unix_micros("ts") / 3_600_000_000) + 1) * 3_600_000)
                        .cast("long").alias("window_end_ms"))
             .agg(F.count_distinct("user_id").alias("uv")).collect()}
    full = {r.window_end_ms: r.uv for r in O.unique_visitors_bitmap(df, "user_id", "ts", 3600).collect()}
    small = {r.window_end_ms: r.uv for r in O.unique_visitors_bitmap(df, "user_id", "ts", 3600, 6).collect()}
    assert full == exact                      # 2^29 bits: no collisions among these ids
    assert all(small[w] <= exact[w] and small[w] <= 64 for w in exact)
