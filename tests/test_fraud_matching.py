"""Click filter, interval join, one-to-one matching, late split, bitmap hash."""

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions import bitmap_offset
from tidemark.operators import (
    ad_click_filter,
    ad_click_warnings,
    split_late,
    tx_interval_join,
    tx_match,
)

T0 = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)  # midnight UTC = 08:00 UTC+8


def _at(s):
    return T0 + dt.timedelta(seconds=s)


def clicks(spark, recs):
    return spark.createDataFrame([(i, u, a, _at(s)) for i, (u, a, s) in enumerate(recs)],
                                 "event_id long, user_id long, ad_id long, ts timestamp")


def test_click_limit_and_local_day(spark):
    h = 3600
    recs = [(1, 7, 0), (1, 7, 1), (1, 7, 2), (1, 7, 3),          # 4 clicks: 2 pass, warn at 3rd
            (2, 7, 0), (2, 7, 1),                                # exactly N: no warning
            (3, 7, 15 * h), (3, 7, 15.5 * h), (3, 7, 16 * h)]    # 16:00 UTC starts a new local day
    df = clicks(spark, recs)
    passed = rows(ad_click_filter(df, 2), ["event_id"])
    assert passed == [(0,), (1,), (4,), (5,), (6,), (7,), (8,)]
    warn = ad_click_warnings(df, 2).collect()
    assert [(r.user_id, r.event_id) for r in warn] == [(1, 2)]
    day_start = int((T0 - dt.timedelta(hours=8)).timestamp() * 1000)
    assert warn[0].day_start_ms == day_start


def _side(spark, recs):
    return spark.createDataFrame([(i, k, _at(s)) for i, (k, s) in recs],
                                 "event_id long, tx_id long, ts timestamp")


def test_interval_join_bounds_inclusive(spark):
    pays = _side(spark, [(1, (1, 100)), (2, (2, 100))])
    recs = _side(spark, [(10, (1, 97)), (11, (1, 105)), (12, (1, 96.999)), (13, (1, 105.001)),
                         (14, (2, 100)), (15, (3, 100))])
    got = rows(tx_interval_join(pays, recs, 3, 5), ["pay_event_id", "receipt_event_id"])
    assert got == [(1, 10), (1, 11), (2, 14)]


def test_interval_join_hot_key_many_buckets(spark):
    # one key, 200 pays and receipts spread over time: only close pairs meet
    pays = _side(spark, [(i, (1, i * 10)) for i in range(200)])
    recs = _side(spark, [(1000 + i, (1, i * 10 + 4)) for i in range(200)])
    got = tx_interval_join(pays, recs, 3, 5)
    assert got.count() == 200


def test_tx_match_slot_rule(spark):
    pays = _side(spark, [(1, (1, 0)), (2, (1, 10)), (3, (2, 0)), (4, (4, 0)),
                         (5, (5, 100)), (6, (5, 200)),        # an early unmatched pay, then a match
                         (7, (6, 0)), (8, (6, 1)),            # a newer pay takes the slot
                         (9, (None, 0))])
    recs = _side(spark, [(11, (1, 2)), (12, (1, 20)), (13, (2, 3.5)), (14, (3, 0)), (15, (5, 201)),
                         (16, (6, 3)), (17, (6, 3.5)), (18, (None, 1)), (19, (4, 3))])
    got = rows(tx_match(pays, recs, 3), ["kind", "pay_event_id", "receipt_event_id"])
    assert got == [("matched", 1, 11), ("matched", 4, 19), ("matched", 6, 15), ("matched", 8, 16),
                   ("order_only", 2, None), ("order_only", 3, None), ("order_only", 5, None),
                   ("order_only", 7, None), ("order_only", 9, None),
                   ("receipt_only", None, 12), ("receipt_only", None, 13), ("receipt_only", None, 14),
                   ("receipt_only", None, 17), ("receipt_only", None, 18)]


def test_matches_carry_the_records_and_pays_can_be_filtered(spark):
    pays = _side(spark, [(1, (1, 0)), (2, (2, 0))]).selectExpr("*", "if(event_id = 1, 'pay', 'create') AS event")
    recs = _side(spark, [(11, (1, 2)), (12, (2, 2))]).selectExpr("*", "'alipay' AS pay_channel")
    got = {r.kind: r for r in tx_match(pays, recs, 3, pay_filter=F.col("event") == "pay").collect()}
    assert set(got) == {"matched", "receipt_only"}
    assert got["matched"].pay.event == "pay" and got["matched"].receipt.pay_channel == "alipay"
    assert got["receipt_only"].pay is None and got["receipt_only"].receipt.tx_id == 2
    joined = tx_interval_join(pays, recs, 3, 5).collect()
    assert {(r.pay.event, r.receipt.pay_channel) for r in joined} == {("pay", "alipay"), ("create", "alipay")}


def test_floor_div_is_exact(spark):
    from tidemark.functions.time import floor_div
    values = [2**63 - 1, -2**62 - 1, -1, 0, 9, 10, 2**53 + 1]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert {r.v: r.d for r in df.select("v", floor_div(F.col("v"), 10).alias("d")).collect()} == {v: v // 10 for v in values}


def test_running_visitors_tell_equal_lines_apart(spark):
    from tidemark.operators import running_unique_visitors
    df = spark.createDataFrame([(7, 1, _at(0)), (7, 1, _at(0)), (8, 2, _at(1)), (8, 2, _at(1))],
                               "event_id long, user_id long, ts timestamp")
    assert sorted(r.uv for r in running_unique_visitors(df).collect()) == [1, 1, 2, 2]
    assert sorted(r.uv for r in running_unique_visitors(df, chunk_us=1).collect()) == [1, 1, 2, 2]


def test_late_access_log_end_to_end(spark, tmp_path):
    from tidemark.sources import text
    lines = ["a u 2020/10/06 12:21:00 GET /x", "a u 2020/10/06:14:00:00 GET /y", "a u 2020/10/06 12:22:00 GET /z"]
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.txt").write_text("\n".join(lines))
    log = text.load_access_log(spark, str(tmp_path / "log")).withColumn(
        "arr", F.when(F.col("url") == "/z", 3).when(F.col("url") == "/y", 2).otherwise(1).cast("long"))
    late = split_late(log, F.col("arr"), size_s=600, slide_s=10)
    assert [(r.url, r.method) for r in late.filter("is_late").collect()] == [("/z", "GET")] and late.count() == 3


def test_split_late(spark):
    # tumbling 10 s, delay 2 s, lateness 1 s; arrival order = list order
    recs = [(0, 1), (1, 15), (2, 5), (3, 30), (4, 12), (5, 19)]
    df = spark.createDataFrame([(i, _at(s), j) for j, (i, s) in enumerate(recs)],
                               "event_id long, ts timestamp, arr long")
    out = split_late(df, F.col("arr"), "ts", "event_id", 10, None, 2, 1)
    late = rows(out.filter("is_late"), ["event_id"])
    # event 2 (ts 5, window end 10): 10+1 <= 15-2 -> late; event 4 (ts 12, end 20): 21 <= 28 -> late
    # event 5 (ts 19, end 20): 21 <= 28 -> late
    assert late == [(2,), (4,), (5,)]


def _py_offset(s, bits=29, seed=26):
    h = 0
    for ch in s:
        h = (h * seed + ord(ch)) & 0xFFFFFFFF   # 32-bit wrap-around
    return h & ((1 << bits) - 1)


def test_bitmap_offset_matches_32bit_hash(spark):
    vals = ["0", "7", "12345", "987654321012", "abcXYZ", ""]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = {r.v: r.o for r in df.select("v", bitmap_offset(F.col("v")).alias("o")).collect()}
    assert got == {v: _py_offset(v) for v in vals}
    small = {r.v: r.o for r in df.select("v", bitmap_offset(F.col("v"), 6).alias("o")).collect()}
    assert small == {v: _py_offset(v, 6) for v in vals}


def test_bitmaps_merge_roll_up_and_answer(spark):
    from pyspark.sql import functions as F

    from tidemark.operators import (
        count_visitor_bitmaps, merge_visitor_bitmaps, rollup_visitor_bitmaps, unique_visitors_bitmap, visitor_bitmaps,
        visitor_bits)

    ev = spark.range(4000).selectExpr("id AS event_id", "if(id % 50 = 0, null, id * 7919 % 1000) AS user_id",
                                      "timestamp_seconds(id * 60) AS ts").repartition(5)
    for bits in (6, 16, 29):      # 6: users share bits
        table = visitor_bitmaps(ev, log2_bits=bits)
        expect = rows(unique_visitors_bitmap(ev.filter("user_id IS NOT NULL"), log2_bits=bits))
        assert rows(count_visitor_bitmaps(table)) == expect
        parts = [visitor_bitmaps(ev.filter(F.col("event_id") % 3 == i), log2_bits=bits) for i in range(3)]
        assert rows(count_visitor_bitmaps(merge_visitor_bitmaps(*parts, parts[0]))) == expect
        days = rollup_visitor_bitmaps(table)
        assert rows(count_visitor_bitmaps(days)) == rows(
            unique_visitors_bitmap(ev.filter("user_id IS NOT NULL"), window_s=86400, log2_bits=bits))
        longest = table.agg(F.max(F.length("bits")), F.max("bucket")).first()
        assert longest[0] == 4096 and longest[1] <= max(1, (1 << bits) // 32768)
    first = 3_600_000
    probes = spark.createDataFrame([(first, 7919 % 1000), (first, 7919 * 59 % 1000), (first, 7919 * 60 % 1000), (1, 5)],
                                   "window_end_ms long, user_id long")
    assert rows(visitor_bits(visitor_bitmaps(ev), probes)) == sorted(
        [(first, 919, True), (first, 7919 * 59 % 1000, True), (first, 7919 * 60 % 1000, False), (1, 5, False)])
    assert rows(count_visitor_bitmaps(visitor_bitmaps(ev.limit(0)))) == []
