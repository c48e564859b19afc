"""Readers for the driver's parquet tables and the mapping of ``events`` onto
the record types of the original jobs (FIXTURES.md §B).

Every adapter is a projection (plus at most an equality filter) of ``events``,
so Catalyst prunes columns and pushes the ``event_type`` predicate to the scan.
All adapters keep ``event_id`` (the tie-break of the total order ``(ts,
event_id)``) and an instant-typed ``ts``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.time import as_event_time

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with ``ts`` as an instant (TIMESTAMP, read as UTC)."""
    df = read_table(spark, sf_dir, "events")
    return df.withColumn("ts", as_event_time(df, "ts"))


def _k(props: str = "props"):
    return F.get_json_object(F.col(props), "$.k").cast("bigint")


def user_behavior(ev: DataFrame, item_mod: int = 20) -> DataFrame:
    """UserBehavior: itemId = k % item_mod, behavior 'pv' for views."""
    return ev.select(
        "event_id", "user_id",
        (_k() % item_mod).alias("item_id"),
        F.lit(0).alias("category_id"),
        F.when(F.col("event_type") == "view", F.lit("pv")).otherwise(F.col("event_type")).alias("behavior"),
        "ts")


def page_views_input(ev: DataFrame, item_mod: int = 20) -> DataFrame:
    """UserBehavior rows with behavior 'pv' (the only value the jobs count)."""
    return user_behavior(ev.filter(F.col("event_type") == "view"), item_mod)


def access_log(ev: DataFrame, url_mod: int = 10) -> DataFrame:
    """ApacheLogEvent: method GET for clicks, url '/p/' || k % url_mod."""
    return ev.select(
        "event_id",
        F.lit("0.0.0.0").alias("ip"),
        F.col("user_id").cast("string").alias("user_id"),
        F.when(F.col("event_type") == "click", F.lit("GET")).otherwise(F.lit("POST")).alias("method"),
        F.concat(F.lit("/p/"), (_k() % url_mod).cast("string")).alias("url"),
        "ts")


def get_requests(ev: DataFrame, url_mod: int = 10) -> DataFrame:
    return access_log(ev.filter(F.col("event_type") == "click"), url_mod)


def ad_clicks(ev: DataFrame, ad_mod: int = 7, province_mod: int = 5) -> DataFrame:
    """AdClickLog from click events: adId = k % ad_mod, province = user_id % province_mod."""
    return ev.filter(F.col("event_type") == "click").select(
        "event_id", "user_id",
        (_k() % ad_mod).alias("ad_id"),
        (F.col("user_id") % province_mod).cast("string").alias("province"),
        F.lit("").alias("city"),
        "ts")


def market_behavior(ev: DataFrame, channel_mod: int = 4) -> DataFrame:
    """MarketUserBehavior: channel = k % channel_mod, behavior = event_type."""
    return ev.select(
        "event_id",
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_type").alias("behavior"),
        (_k() % channel_mod).cast("string").alias("channel"),
        "ts")


def logins(ev: DataFrame) -> DataFrame:
    """LoginEvent: error -> 'fail', signup -> 'success'; other types dropped."""
    return ev.filter(F.col("event_type").isin("error", "signup")).select(
        "event_id", "user_id",
        F.lit("0.0.0.0").alias("ip"),
        F.when(F.col("event_type") == "error", F.lit("fail")).otherwise(F.lit("success")).alias("event_type"),
        "ts")


def order_events(ev: DataFrame) -> DataFrame:
    """OrderPayEvent: signup -> 'create', purchase -> 'pay'; order_id = user_id."""
    return ev.filter(F.col("event_type").isin("signup", "purchase")).select(
        "event_id",
        F.col("user_id").alias("order_id"),
        F.when(F.col("event_type") == "signup", F.lit("create")).otherwise(F.lit("pay")).alias("event"),
        F.when(F.col("event_type") == "purchase", F.col("user_id")).alias("tx_id"),
        "ts")


def payments(ev: DataFrame) -> DataFrame:
    """Pay events (left side of the tx match): purchases, tx_id = user_id."""
    return ev.filter(F.col("event_type") == "purchase").select(
        "event_id", F.col("user_id").alias("tx_id"), F.lit("pay").alias("event"), "ts")


def receipts(ev: DataFrame) -> DataFrame:
    """ReceiptEvent (right side): clicks, tx_id = user_id."""
    return ev.filter(F.col("event_type") == "click").select(
        "event_id", F.col("user_id").alias("tx_id"), F.lit("app").alias("pay_channel"), "ts")


def with_arrival(ev: DataFrame) -> DataFrame:
    """Arrival time for late-data tests: ts + value minutes."""
    return ev.withColumn(
        "arrival_us",
        F.unix_micros("ts") + F.round(F.col("value") * F.lit(60_000_000)).cast("bigint"))
