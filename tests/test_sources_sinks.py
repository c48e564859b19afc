"""Text loaders (batch and file stream), Kafka option builders, sinks, report."""

import datetime as dt

import pytest

from tests.conftest import rows
from tidemark.operators import format_top_n_report, top_n
from tidemark.sources import kafka, text
from tidemark.streaming import read_upserted, upsert_sink


def _write(tmp_path, name, lines):
    d = tmp_path / name
    d.mkdir()
    (d / "part-0.csv").write_text("\n".join(lines) + "\n")
    return str(d)


def test_user_behavior_seconds(spark, tmp_path):
    path = _write(tmp_path, "ub", ["543462,1715,1464116,pv,1511658000",
                                   "662867,2244074,1575622,pv,1511658000"])
    df = text.load_user_behavior(spark, path)
    r = df.orderBy("user_id").first()
    assert (r.user_id, r.item_id, r.category_id, r.behavior) == (543462, 1715, 1464116, "pv")
    assert r.ts == dt.datetime.fromtimestamp(1511658000, dt.timezone.utc).replace(tzinfo=None)


def test_bad_rows_modes(spark, tmp_path):
    path = _write(tmp_path, "bad", ["1,2,3,pv,100", "x,2,3,pv,100", "1,2", "4,5,6,pv,y"])
    assert text.load_user_behavior(spark, path, on_bad="drop").count() == 1
    kept = text.load_user_behavior(spark, path, on_bad="keep")
    assert kept.count() == 4 and kept.filter("ts IS NULL").count() == 2
    with pytest.raises(Exception, match="malformed input row"):
        text.load_user_behavior(spark, path).collect()


@pytest.mark.parametrize("on_bad, rows_out", [("drop", 1), ("keep", 3)])
def test_rejects_are_counted_by_every_loader(spark, tmp_path, on_bad, rows_out):
    from pyspark.sql import Observation

    def counted(load):
        seen = Observation()
        assert load(on_bad=on_bad, rejects=seen).count() == rows_out
        assert seen.get == {"bad_rows": 2, "rows": 3}
    csv = _write(tmp_path, "csv", ["1,2,3,pv,100", "x,2,3,pv,100", "1"])
    counted(lambda **kw: text.load_user_behavior(spark, csv, **kw))
    receipts = _write(tmp_path, "rc", ["3,alipay,100", "x,alipay,100", ",alipay,100"])   # a receipt needs its id
    counted(lambda **kw: text.load_receipts(spark, receipts, **kw))
    log = _write(tmp_path, "alog", ["i u 2020/10/06 12:21:00 GET /", "i u 06.10.2020 12:21:00 GET /", "i u 2020/10/06"])
    counted(lambda **kw: text.load_access_log(spark, log, **kw))
    values = spark.createDataFrame([("1,2,3,pv,100",), ("a,b",), (None,)], "value string")
    counted(lambda **kw: text.parse_csv_value(values, text.USER_BEHAVIOR_SCHEMA, "s", **kw))


def test_order_events_empty_tx_and_ms(spark, tmp_path):
    path = _write(tmp_path, "orders", ["34729,create,,1558430842000", "34729,pay,sd76f87d6,1558430844000",
                                       "34730,pay,77,1558430845123"])
    df = text.load_order_events(spark, path, on_bad="keep")
    got = rows(df, ["order_id", "event", "tx_id"])
    assert got == [(34729, "create", None), (34729, "pay", None), (34730, "pay", 77)]
    assert df.filter("order_id = 34730").first().ts.microsecond == 123000


def test_other_loaders(spark, tmp_path):
    clicks = text.load_ad_clicks(spark, _write(tmp_path, "ad", ["561558,3611281,guangdong,shenzhen,1511658000000"]))
    assert clicks.first().province == "guangdong"
    logins = text.load_logins(spark, _write(tmp_path, "lg", ["5402,83.149.11.115,success,1558430815"]))
    assert logins.first().event_type == "success"
    rec = text.load_receipts(spark, _write(tmp_path, "rc", ["3,alipay,1558430847000"]))
    assert rec.first().pay_channel == "alipay"
    mk = text.load_market_behavior(spark, _write(tmp_path, "mk", ["u1,install,wechat,1558430847000"]))
    assert mk.first().channel == "wechat"


def test_access_log_patterns(spark, tmp_path):
    path = _write(tmp_path, "log", ["83.149.9.216 - 2020/10/06 12:21:05 GET /a", "83.149.9.216 - 2020/10/06:12:21:05 POST /b"])
    df = text.load_access_log(spark, path)
    assert rows(df, ["ip", "method", "url"]) == [("83.149.9.216", "GET", "/a"), ("83.149.9.216", "POST", "/b")]
    assert {r.ts for r in df.collect()} == {dt.datetime(2020, 10, 6, 12, 21, 5)}
    other = _write(tmp_path, "log2", ["83.149.9.216 - 17/05/2015:10:05:03 GET /presentations/"])
    with pytest.raises(Exception, match="malformed input row"):
        text.load_access_log(spark, other).collect()
    df = text.load_access_log(spark, other, time_pattern="dd/MM/yyyy:HH:mm:ss")
    assert rows(df, ["ts", "url"]) == [(dt.datetime(2015, 5, 17, 10, 5, 3), "/presentations/")]


def test_file_stream_loader(spark, tmp_path):
    path = _write(tmp_path, "stream", ["1,2,3,pv,100", "4,5,6,pv,200"])
    df = text.load_user_behavior(spark, path, stream=True)
    assert df.isStreaming
    q = df.writeStream.format("memory").queryName("tidemark_ub_stream") \
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("tidemark_ub_stream").count() == 2


def test_kafka_value_parser_and_options(spark):
    values = spark.createDataFrame([("1,2,3,pv,100",), ("7,8,9,buy,200",)], "value string")
    parsed = text.parse_csv_value(values, text.USER_BEHAVIOR_SCHEMA, "s")
    assert rows(parsed, ["user_id", "behavior"]) == [(1, "pv"), (7, "buy")]
    opts = kafka.kafka_options("broker:9092", "topic-items", "consumer-hotitems")
    assert opts == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "topic-items",
                    "startingOffsets": "latest", "kafka.group.id": "consumer-hotitems"}


def test_top_n_report(spark):
    counts = spark.createDataFrame([(3600000, 1, 5), (3600000, 2, 7), (3600000, 3, 7), (3600000, 4, 1)],
                                   "window_end_ms long, item_id long, cnt long")
    rep = format_top_n_report(top_n(counts, "window_end_ms", "item_id", 3)).first().report
    lines = rep.split("\n")
    assert lines[0] == "窗口结束时间：1970-01-01 00:59:59.999"
    assert lines[1] == "NO. 0: 商品标号:2, 热门度:7"
    assert lines[2] == "NO. 1: 商品标号:3, 热门度:7"
    assert lines[3] == "NO. 2: 商品标号:1, 热门度:5"
    assert lines[4] == "=" * 41


def test_upsert_sink_keeps_latest(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.csv").write_text("1,2,3,pv,100\n4,5,6,pv,200\n")
    stream = text.load_user_behavior(spark, str(src), stream=True)
    counts = stream.groupBy("behavior").count()
    out = str(tmp_path / "out")
    q = upsert_sink(counts, out, ["behavior"], "tidemark_upsert", checkpoint=str(tmp_path / "ck"))
    q.processAllAvailable()
    (src / "b.csv").write_text("7,8,9,pv,300\n")
    q.processAllAvailable()
    q.stop()
    latest = read_upserted(spark, out, ["behavior"])
    assert rows(latest, ["behavior", "count"]) == [("pv", 3)]


def test_upsert_log_is_compacted(spark, tmp_path):
    import os

    src = tmp_path / "src"
    src.mkdir()
    stream = text.load_user_behavior(spark, str(src), stream=True)
    counts = stream.groupBy("behavior").count()
    out = str(tmp_path / "out")
    q = upsert_sink(counts, out, ["behavior"], "tidemark_compact", checkpoint=str(tmp_path / "ck"), compact_every=2)
    for i in range(5):
        (src / f"{i}.csv").write_text(f"{i},2,3,{'pv' if i % 2 else 'buy'},100\n")
        q.processAllAvailable()
    q.stop()
    assert rows(read_upserted(spark, out, ["behavior"]), ["behavior", "count"]) == [("buy", 3), ("pv", 2)]
    folders = [f for f in os.listdir(out) if not f.startswith((".", "_"))]
    assert sum(f.startswith("snapshot_") for f in folders) == 1 and len(folders) <= 3


def test_scale_settings():
    from tidemark.session import scale_settings

    big = scale_settings(100 * 10**12)
    assert big["spark.sql.shuffle.partitions"] == str(-(-100 * 10**12 // (256 << 20)))
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert scale_settings(10**9)["spark.sql.shuffle.partitions"] == "200"


def test_session_names_no_master_and_no_local_folder_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from tidemark import session

    set_to = {}

    class Builder:
        def __getattr__(self, name):
            return lambda *a: (set_to.update([a if len(a) == 2 else (name, a[0])]), self)[1] if a else spark
    monkeypatch.setattr(session, "SparkSession", SimpleNamespace(builder=Builder()))
    monkeypatch.delenv("TIDEMARK_MASTER", raising=False)
    session.get_session(input_bytes=10**12)
    assert "master" not in set_to and set_to["spark.sql.shuffle.partitions"] == "3726"
    conf = SimpleNamespace(get=lambda *a: None)
    cluster = SimpleNamespace(sparkContext=SimpleNamespace(master="yarn", getCheckpointDir=lambda: None, getConf=lambda: conf), conf=conf)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(cluster)


def test_text_jobs_end_to_end(spark, tmp_path):
    """The original jobs' inputs straight from text: order outcomes (create/pay
    with 15 min limit) and the order/receipt match."""
    from pyspark.sql import functions as F

    from tidemark.operators import order_pay_match, tx_match

    orders = text.load_order_events(spark, _write(tmp_path, "o", [
        "1,create,,1558430842000", "1,pay,11,1558430900000",
        "2,create,,1558430842000", "3,pay,33,1558430842000"]), on_bad="keep")
    got = rows(order_pay_match(orders), ["order_id", "result"])
    assert got == [(1, "pay success"), (2, "create but not payed"), (3, "payed but not found create")]
    receipts = text.load_receipts(spark, _write(tmp_path, "r", ["11,alipay,1558430901000",
                                                                 "99,wechat,1558430901000"]))
    got = rows(tx_match(orders, receipts, 5, pay_filter=(F.col("event") == "pay") & F.col("tx_id").isNotNull()),
               ["tx_id", "kind"])
    assert got == [(11, "matched"), (33, "order_only"), (99, "receipt_only")]
