"""segmented_scan equals a plain Spark window over the whole key."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import scan
from tidemark.operators.scan import Chunks, ScanAgg, chunks_for, heavy_keys, segmented_scan


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(5)
    # key 0 is hot: most rows, spread over many chunks
    recs = [(i, 0 if rnd.random() < 0.7 else rnd.randrange(1, 4), rnd.randrange(10_000),
             rnd.choice([None, rnd.randrange(100)])) for i in range(600)]
    return spark.createDataFrame(recs, "id long, k long, t long, v long")


@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("inclusive", [False, True])
def test_scan_matches_window(spark, data, reverse, inclusive):
    order = [F.col("t").desc(), F.col("id").desc()] if reverse else [F.col("t"), F.col("id")]
    w = Window.partitionBy("k").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1)
    expect = data.select(
        "id", F.sum("v").over(w).alias("s"), F.min("v").over(w).alias("mn"),
        F.max("v").over(w).alias("mx"), F.last("v", ignorenulls=True).over(w).alias("near"))
    got = segmented_scan(
        data, ["k"], ["t", "id"],
        [ScanAgg("s", "sum", F.col("v")), ScanAgg("mn", "min", F.col("v")),
         ScanAgg("mx", "max", F.col("v")), ScanAgg("near", "nearest", F.col("v"))],
        (F.col("t") / 500).cast("long"), reverse=reverse, inclusive=inclusive)
    exp = {r["id"]: (r["s"] or 0, r["mn"], r["mx"], r["near"]) for r in expect.collect()}
    for r in got.collect():
        assert (r["s"], r["mn"], r["mx"], r["near"]) == exp[r["id"]], r


def test_global_scan_without_key(spark, data):
    w = Window.orderBy("t", "id").rowsBetween(Window.unboundedPreceding, -1)
    expect = rows(data.select("id", F.max("t").over(w).alias("m")))
    got = rows(segmented_scan(data, [], ["t", "id"], [ScanAgg("m", "max", F.col("t"))],
                              (F.col("t") / 100).cast("long")).select("id", "m"))
    assert got == expect


@pytest.mark.parametrize("reverse", [False, True])
def test_next_prev_match_lead_lag(spark, data, reverse):
    order = [F.col("t").desc(), F.col("id").desc()] if reverse else [F.col("t"), F.col("id")]
    w = Window.partitionBy("k").orderBy(*order)
    payload = F.struct(F.col("t").alias("t"), F.col("v").alias("v"))
    expect = data.select("id", F.lead(payload).over(w).alias("n"), F.lag(payload).over(w).alias("p"),
                         F.lead("v").over(w).alias("nv"))
    got = segmented_scan(data, ["k"], ["t", "id"],
                         [ScanAgg("n", "next", payload), ScanAgg("p", "prev", payload),
                          ScanAgg("nv", "next", F.col("v"))],
                         (F.col("t") / 500).cast("long"), reverse=reverse)
    exp = {r["id"]: (r["n"], r["p"], r["nv"]) for r in expect.collect()}
    for r in got.collect():
        assert (r["n"], r["p"], r["nv"]) == exp[r["id"]], r


def test_null_keys_scan_separately(spark):
    data = spark.createDataFrame([(1, None, 1, 5), (2, None, 2, 7), (3, 0, 1, 100), (4, 0, 3, 1)],
                                 "id long, k long, t long, v long")
    got = segmented_scan(data, ["k"], ["t", "id"], [ScanAgg("s", "sum", F.col("v"))],
                         F.lit(0).cast("long"), inclusive=True)
    assert {r["id"]: r["s"] for r in got.collect()} == {1: 5, 2: 12, 3: 100, 4: 101}


def plan_of(spark, df):
    """Static plan: AQE off, no broadcast by size."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("carried", [[], ["v"]])
def test_rows_are_shuffled_once_and_the_exchange_is_reused(spark, tmp_path, data, carried):
    data.write.parquet(str(tmp_path / "t"))
    src = spark.read.parquet(str(tmp_path / "t")).select("id", "k", "t", *carried)
    out = segmented_scan(src, ["k"], ["t", "id"], [ScanAgg("s", "prev", F.col("t"))], (F.col("t") / 500).cast("long"))
    plan = plan_of(spark, out)
    # the rows by (key, chunk), the chunk rows by key, their prefix by (key, chunk)
    assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") == 1, plan
    assert plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange") <= 3, plan


def test_small_inputs_are_one_window(spark, data, tmp_path, monkeypatch):
    data.write.parquet(str(tmp_path / "t"))
    src = spark.read.parquet(str(tmp_path / "t"))

    def plan():
        return plan_of(spark, segmented_scan(src, ["k"], ["t", "id"], [ScanAgg("s", "sum", F.col("v"))], chunks_for(src, "t")))
    assert plan().count("Exchange") == 1 and "Join" not in plan()
    monkeypatch.setattr(scan, "SMALL_BYTES", 100)      # by its size alone: the rows are not counted
    assert "approx_top_k_combine" in plan()


@pytest.mark.parametrize("rows_each", [20, 100, 1000])
def test_heavy_keys_are_cut(spark, data, rows_each):
    """All keys over the limit and only they are cut, to chunks near the wanted size, and the rows stay the same."""
    counts = {r.k: r["count"] for r in data.groupBy("k").count().collect()}
    named = {r.k: r.h for r in data.select("k", F.xxhash64("k").alias("h")).distinct().collect()}
    heavy = {r["__h"]: r["__width"] for r in heavy_keys(data, ["k"], "t", rows_each).collect()}
    assert set(heavy) == {named[k] for k, n in counts.items() if n > rows_each}
    for k in named:
        if named[k] in heavy:
            chunks = data.filter(F.col("k").eqNullSafe(F.lit(k))).groupBy(F.floor(F.col("t") / heavy[named[k]])).count()
            assert chunks.agg(F.max("count")).first()[0] <= 2 * rows_each
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, -1)
    expect = rows(data.select("id", F.coalesce(F.sum("v").over(w), F.lit(0)).alias("s"), F.last("v", True).over(w).alias("n")))
    got = segmented_scan(data, ["k"], ["t", "id"], [ScanAgg("s", "sum", F.col("v")), ScanAgg("n", "nearest", F.col("v"))],
                         Chunks("t", rows_each))
    assert rows(got.select("id", "s", "n")) == expect


def test_no_heavy_key_is_missed_among_many(spark, monkeypatch):
    """With far more keys than the sketch tracks, every key above its stated bound is named."""
    monkeypatch.setattr(scan, "TRACKED", 1 << 10)      # bound: 2 x 3.5 / 1,024 of the rows
    many = spark.range(100_000).select(F.when(F.col("id") % 20 == 0, F.col("id") % 60).otherwise(F.col("id") + 1000).alias("k"),
                                       F.col("id").alias("t")).repartition(7)
    found = {r["__h"] for r in heavy_keys(many, ["k"], "t", 1000).collect()}
    assert found == {r.h for r in spark.createDataFrame([(0,), (20,), (40,)], "k long").select(F.xxhash64("k").alias("h")).collect()}


@pytest.mark.parametrize("kind", ["date", "string", "boolean", "timestamp", "int"])
def test_key_types(spark, kind):
    values = {"date": "2024-01-0{}", "string": "{}", "boolean": "{}", "timestamp": "2024-01-0{} 00:00:00", "int": "{}"}[kind]
    recs = [(i, None if i % 3 == 2 else values.format(i % 3 + (kind in ("date", "timestamp"))), i) for i in range(12)]
    df = spark.createDataFrame(recs, "id long, k string, t long").withColumn("k", F.col("k").cast(kind))
    got = segmented_scan(df, ["k"], ["t"], [ScanAgg("p", "prev", F.col("t"))], F.floor(F.col("t") / 4))
    assert {r.id: r.p for r in got.collect()} == {i: i - 3 if i >= 3 else None for i in range(12)}


def test_keyless_scan_sized_by_a_subquery(spark, data):
    w = Window.orderBy("t", "id").rowsBetween(Window.unboundedPreceding, -1)
    expect = rows(data.select("id", F.max("t").over(w).alias("m")))
    for n in (10, 200, 100_000):
        got = segmented_scan(data, [], ["t", "id"], [ScanAgg("m", "max", F.col("t"))], Chunks("t", n))
        assert rows(got.select("id", "m")) == expect


@pytest.mark.parametrize("reverse", [False, True])
def test_keyless_scan_over_many_chunks(spark, reverse):
    """More than 1,024 chunks: the prefix over chunk summaries runs as a nested scan."""
    rnd = random.Random(11)
    recs = [(i, rnd.randrange(100_000), rnd.choice([None, rnd.randrange(50)])) for i in range(3000)]
    df = spark.createDataFrame(recs, "id long, t long, v long")
    order = [F.col("t").desc(), F.col("id").desc()] if reverse else [F.col("t"), F.col("id")]
    w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    wr = Window.orderBy(*order)
    expect = {r["id"]: (r["s"] or 0, r["mx"], r["near"], r["nx"]) for r in df.select(
        "id", F.sum("v").over(w).alias("s"), F.max("v").over(w).alias("mx"),
        F.last("v", ignorenulls=True).over(w).alias("near"), F.lead("v").over(wr).alias("nx")).collect()}
    got = segmented_scan(df, [], ["t", "id"],
                         [ScanAgg("s", "sum", F.col("v")), ScanAgg("mx", "max", F.col("v")),
                          ScanAgg("near", "nearest", F.col("v")), ScanAgg("nx", "next", F.col("v"))],
                         (F.col("t") / 30).cast("long"), reverse=reverse)
    for r in got.collect():
        assert (r["s"], r["mx"], r["near"], r["nx"]) == expect[r["id"]], r
