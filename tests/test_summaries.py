"""Top-N per sliding window from frequent-items summaries equals the ranking of all counts."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark import operators as O

COLS = ["window_end_ms", "item", "cnt", "rank_no"]


def skewed(spark, n=30_000, keys=5_000):
    """Two hours of rows: a third of them on one key, the rest falling off over ``keys``."""
    u = (F.pmod(F.xxhash64("id"), F.lit(10_007)) / F.lit(10_007.0))
    item = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.floor(F.pow(u, 6) * keys)).cast("bigint")
    ts = F.timestamp_seconds(F.pmod(F.xxhash64("id", F.lit("t")), F.lit(7200)) + 1_700_000_000)
    return spark.range(n).select(item.alias("item"), ts.alias("ts"))


def plain(df, n):
    return rows(O.top_n(O.sliding_count(df, ["item"], "ts", 3600, 300, "expand"), "window_end_ms", "item", n), COLS)


@pytest.mark.parametrize("tracked, kept", [(2048, 64), (64, 8), (8, 5)])
def test_equals_the_ranking_of_all_counts(spark, tracked, kept):
    df = skewed(spark)
    assert rows(O.sliding_top_n(df, "item", 5, 3600, 300, tracked=tracked, kept=kept), COLS) == plain(df, 5)


def test_flat_ties_null_and_empty(spark):
    flat = skewed(spark, 4_000).withColumn("item", F.when(F.col("item") % 5 != 0, F.col("item") * 1_000))
    assert rows(O.sliding_top_n(flat, "item", 3, 3600, 300, tracked=16, kept=4), COLS) == plain(flat, 3)
    ties = spark.range(900).select((F.col("id") % 300).alias("item"), F.timestamp_seconds(F.col("id") % 3).alias("ts"))
    assert rows(O.sliding_top_n(ties, "item", 3, 3600, 300, tracked=16, kept=4), COLS) == plain(ties, 3)
    assert O.sliding_top_n(skewed(spark, 0), "item", 3, 3600, 300).count() == 0


def test_text_keys_and_wrong_sizes(spark):
    df = skewed(spark, 6_000).withColumn("item", F.concat(F.lit("/p/"), "item"))
    assert rows(O.sliding_top_n(df, "item", 5, 600, 60, tracked=64, kept=8), COLS) == rows(
        O.top_n(O.sliding_count(df, ["item"], "ts", 600, 60), "window_end_ms", "item", 5), COLS)
    with pytest.raises(ValueError):
        O.sliding_top_n(df, "item", 5, 600, 60, tracked=8, kept=4)
