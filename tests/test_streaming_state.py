"""Rankings and distinct counts in state, restarts, dead letters."""

import itertools
import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import Window

from tests.conftest import SF_SMALL, rows
from tests.test_streaming import FAR, _no_sentinel, as_stream, run_stream
from tidemark import operators as O
from tidemark import streaming as S
from tidemark.sources import tables as T
from tidemark.sources import text

_ids = itertools.count()
NOW = {"availableNow": True}


def views(spark):
    return T.page_views_input(T.events(spark, SF_SMALL)).select("event_id", "item_id", "user_id", "ts", "behavior")


def test_ranking_in_state_equals_batch_after_late_rows(spark):
    v = views(spark)
    late = F.unix_micros("ts") + F.pmod(F.xxhash64("event_id"), F.lit(5 * 86400)) * 1_000_000      # up to 5 days late
    far = F.unix_millis(F.lit(FAR).cast("timestamp"))
    cols = ["window_end_ms", "item_id", "cnt", "rank_no"]
    for parts in (1, 3):
        out = S.stream_ranking_changes(as_stream(spark, v, ["item_id"], 8, late), "item_id", 2, 3600, 1800,
                                       lateness_s=6 * 86400, parts=parts)
        changes = run_stream(out, "update").filter(F.col("window_end_ms") < far)
        assert rows(S.current_ranking(changes, "item_id", 2), cols) == rows(O.hot_items(v, 2, 3600, 1800), cols)
        assert changes.filter("version > 1").count()


def test_running_visitors_in_state_equal_batch(spark):
    v = views(spark)
    got = run_stream(S.stream_running_unique_visitors_exact(as_stream(spark, v, ["user_id"], 4)))
    want = O.running_unique_visitors(v, "user_id", "ts", "event_id", 3600)
    cols = ["event_id", "uv"]
    assert rows(_no_sentinel(got, "event_id"), cols) == rows(want.withColumnRenamed("running_uv", "uv"), cols)


def _feed(df, path, tiles, which):
    cut = df.withColumn("__t", F.ntile(tiles).over(Window.orderBy("ts", "event_id")))
    for i in which:
        cut.filter(F.col("__t") == i).drop("__t").coalesce(1).write.mode("append").parquet(path)


def _replay_last(checkpoint):
    """Forget that the last batch was committed, as if the driver was lost before it could say so."""
    commits = f"{checkpoint}/commits"
    last = max(int(f) for f in os.listdir(commits) if f.isdigit())
    os.truncate(f"{commits}/{last}", 0)
    os.remove(f"{commits}/{last}")
    for crc in (f"{commits}/.{last}.crc",):
        if os.path.exists(crc):
            os.remove(crc)


def test_restart_and_replayed_batch_give_the_unbroken_output(spark):
    ev = T.events(spark, SF_SMALL)
    orders = T.order_events(ev)
    forms = {
        "orders": (orders, lambda s: S.stream_order_pay_match(s, 86400), "order_id", O.order_pay_match(orders, 86400)),
        "visitors": (views(spark), S.stream_running_unique_visitors_exact, "event_id", None),
    }
    for form, (df, op, key, batch) in forms.items():
        path, out, ck = tempfile.mkdtemp(), tempfile.mkdtemp(), tempfile.mkdtemp()
        far = df.limit(1).withColumn("ts", F.lit(FAR).cast("timestamp")).withColumn(key, F.lit(-1).cast("bigint"))

        def run():
            stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
            q = S.start_sink(op(stream), f"tidemark_r{next(_ids)}", "parquet", path=out, checkpoint=ck, trigger=NOW)
            q.awaitTermination(300)
            return q
        _feed(df, path, 4, (1, 2))
        run()
        _replay_last(ck)
        run()
        held = spark.read.format("state-metadata").load(ck)
        assert held.count() >= 1
        _feed(df, path, 4, (3, 4))
        far.coalesce(1).write.mode("append").parquet(path)
        last = run()
        got = spark.read.parquet(out).filter(F.col(key) != -1)
        want = batch if batch is not None else O.running_unique_visitors(df, "user_id", "ts", "event_id", 3600)
        if form == "visitors":
            got, want = got.select("event_id", "uv"), want.select("event_id", F.col(want.columns[-1]).alias("uv"))
        assert rows(got) == rows(want), form
        # only what the closing row itself keeps
        assert sum(op.numRowsTotal for op in last.lastProgress.stateOperators) <= 8, form


def test_dead_letters_keep_every_line(spark):
    folder = tempfile.mkdtemp()
    lines = [f"{i},1.2.3.4,fail,{1_500_000_000 + i}" for i in range(500)]
    lines[3], lines[77], lines[499] = "", "x,1.2.3.4,fail,1500000000", "9,1.2.3.4,fail"
    for name in ("a.csv", "b.csv"):
        with open(f"{folder}/{name}", "w") as f:
            f.write("\n".join(lines) + "\n")

    def parse(numbered):
        return text.parse_csv_value(numbered, text.LOGIN_SCHEMA, "s", on_bad="tag", carry=text.RAW)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (old, "2000"):        # one block a file, and many
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            good, bad = text.split_rejects(parse(text.numbered_lines(text.raw_lines(spark, folder))))
            assert good.count() == 2 * 497
            assert rows(good) == rows(text.load_logins(spark, folder, on_bad="drop").select(good.columns))
            want = sorted((n, k + 1, lines[k]) for n in ("a.csv", "b.csv") for k in (3, 77, 499))
            assert sorted((os.path.basename(r.raw_file), r.raw_number, r.raw_line) for r in bad.collect()) == want
            assert "user_id" in bad.filter("raw_number = 78").first().reject_reason
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    out, rejects = tempfile.mkdtemp(), tempfile.mkdtemp()
    S.dead_letter_sink(text.raw_lines(spark, folder, stream=True), parse, out, rejects, f"tidemark_d{next(_ids)}",
                       checkpoint=tempfile.mkdtemp(), trigger=NOW).awaitTermination(120)
    assert spark.read.parquet(out).count() == 2 * 497
    assert sorted(r.raw_number for r in spark.read.parquet(rejects).collect()) == [4, 4, 78, 78, 500, 500]


def test_access_log_lines_are_tagged(spark):
    log = spark.createDataFrame([("1.1.1.1 - 2015/05/17 10:05:03 GET /a", "f", 1), ("broken", "f", 2)], "value string, raw_file string, raw_number bigint")
    tagged = text.parse_access_log(log.withColumn("raw_line", F.col("value")), on_bad="tag", carry=text.RAW)
    good, bad = text.split_rejects(tagged)
    assert good.first().url == "/a" and bad.first().raw_line == "broken"
