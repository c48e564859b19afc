"""The line log: offsets without gaps, restarts, repeated batches, aborted writes, the loaders' parser on top."""

import itertools
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_streaming_state import _replay_last
from tidemark.sources import text
from tidemark.sources.linelog import LineLog

_ids = itertools.count()
NOW = {"availableNow": True}


@pytest.fixture(scope="module")
def log(spark):
    spark.dataSource.register(LineLog)
    return lambda: tempfile.mkdtemp(prefix="tidemark-log-")


def lines(spark, lo, hi):
    return spark.range(lo, hi, 1, 3).select(F.format_string("%d,1.2.3.4,fail,%d", "id", F.col("id") + 1_500_000_000).alias("value"))


def put(df, path, **options):
    df.write.format("linelog").mode("append").options(path=path, partitions=2, **options).save()


def test_offsets_have_no_gaps_and_records_stay_whole(spark, log):
    path = log()
    odd = spark.createDataFrame([("two\nlines",), (None,), ("",), (" é\r",)], "value string")
    put(lines(spark, 0, 1000), path, segmentLines=100)
    put(odd, path)
    got = spark.read.format("linelog").load(path)
    assert rows(got, ["value"]) == rows(lines(spark, 0, 1000).unionByName(odd))
    for p, found in itertools.groupby(rows(got, ["partition", "offset"]), key=lambda r: r[0]):
        offsets = [o for _, o in found]
        assert offsets == list(range(len(offsets)))
    assert spark.read.format("linelog").load(log()).count() == 0


def test_stream_through_two_logs_is_exactly_once(spark, log):
    source, target, ck = log(), log(), tempfile.mkdtemp()

    def run():
        stream = spark.readStream.format("linelog").load(source).select("value")
        (stream.writeStream.format("linelog").options(path=target, partitions=2, writer="copy").option("checkpointLocation", ck)
         .trigger(**NOW).start().awaitTermination(120))
    put(lines(spark, 0, 300), source)
    run()
    _replay_last(ck)                 # the log has the batch, Spark does not know
    run()
    put(lines(spark, 300, 500), source)
    run()
    copied = spark.read.format("linelog").load(target)
    assert rows(copied, ["value"]) == rows(lines(spark, 0, 500))
    assert copied.select("partition", "offset").distinct().count() == 500
    logins = text.parse_csv_value(copied, text.LOGIN_SCHEMA, "s")
    assert logins.filter("event_type = 'fail'").count() == 500


def test_a_failed_write_leaves_nothing(spark, log):
    path = log()
    put(lines(spark, 0, 10), path)
    broken = lines(spark, 0, 50).select(F.when(F.col("value").startswith("49,"), F.raise_error(F.lit("no"))).otherwise(F.col("value")).alias("value"))
    with pytest.raises(Exception, match="no"):
        put(broken, path)
    assert spark.read.format("linelog").load(path).count() == 10
    assert len(os.listdir(f"{path}/manifests")) == 1
    with pytest.raises(Exception, match="appended"):
        lines(spark, 0, 1).write.format("linelog").mode("overwrite").option("path", path).save()
    with pytest.raises(Exception, match="writer"):
        (spark.readStream.format("linelog").load(path).select("value").writeStream.format("linelog").option("path", path)
         .option("checkpointLocation", tempfile.mkdtemp()).trigger(**NOW).start().awaitTermination(60))
