"""Loaders for the original jobs' text inputs (no header), batch or stream.

Each loader reads with a fixed schema (no inference) and adds ``ts`` (an
instant) from the input's time column; the unit is an argument because the
original jobs mix seconds and milliseconds.

One bad-row policy holds for every loader, the access log and Kafka values
included.  A row is bad when a required field or its time is missing or does not
parse.  ``on_bad`` maps the original's "throw on a bad number": ``fail`` (the
query raises on the first bad row; the default), ``drop`` (bad rows are skipped),
``keep`` (every row stays, unparsable fields are null) or ``tag`` (every row stays and
``reject_reason`` names the fields at fault; null in good rows).  ``rejects`` counts the
bad rows: pass an ``Observation`` (batch) or a name (stream progress
events), and read its ``bad_rows`` and ``rows`` after the query ran.  The check
looks at every required field, so it holds whichever columns a query reads
(Spark's CSV column pruning would otherwise only validate the selected columns).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

USER_BEHAVIOR_SCHEMA = "user_id BIGINT, item_id BIGINT, category_id INT, behavior STRING, timestamp BIGINT"
AD_CLICK_SCHEMA = "user_id BIGINT, ad_id BIGINT, province STRING, city STRING, timestamp BIGINT"
LOGIN_SCHEMA = "user_id BIGINT, ip STRING, event_type STRING, timestamp BIGINT"
ORDER_EVENT_SCHEMA = "order_id BIGINT, event STRING, tx_id BIGINT, timestamp BIGINT"
RECEIPT_SCHEMA = "tx_id BIGINT, pay_channel STRING, timestamp BIGINT"
MARKET_SCHEMA = "user_id STRING, behavior STRING, channel STRING, timestamp BIGINT"

ORDER_OPTIONAL = {"tx_id"}   # empty in the create rows of order events
REASON = "reject_reason"
RAW = ["raw_line", "raw_file", "raw_number"]   # what numbered lines carry through a parser
ACCESS_TIME_PATTERNS = ("yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd:HH:mm:ss")


def epoch_to_ts(col: str | Column, unit: str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    if unit == "s":
        return F.timestamp_seconds(c)
    if unit == "ms":
        return F.timestamp_millis(c)
    if unit == "us":
        return F.timestamp_micros(c)
    raise ValueError(f"unknown time unit {unit!r}")


def validate(df: DataFrame, on_bad: str, optional: set[str] = frozenset(),
             rejects: Observation | str | None = None) -> DataFrame:
    """Apply the bad-row policy: a row is bad when a field that is not ``optional`` is null."""
    if on_bad not in ("fail", "drop", "keep", "tag"):
        raise ValueError(f"unknown on_bad {on_bad!r}")
    required = [c for c in df.columns if c not in optional]
    bad = F.lit(False)
    for c in required:
        bad = bad | F.col(c).isNull()
    if rejects is not None:
        df = df.observe(rejects, F.count_if(bad).alias("bad_rows"), F.count(F.lit(1)).alias("rows"))
    if on_bad == "tag":
        missing = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
        return df.withColumn(REASON, F.when(bad, F.concat(F.lit("missing or malformed: "), missing)))
    if on_bad == "drop":
        return df.filter(~bad)
    if on_bad == "fail":
        return df.filter(F.when(bad, F.raise_error(F.lit("malformed input row"))).otherwise(F.lit(True)))
    return df


def _finish(df: DataFrame, on_bad: str, optional: set[str] = frozenset(),
            rejects: Observation | str | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """The policy over all fields and ``ts``; then ``event_id``, the tie-break of the ``(ts, id)``
    order the sequence operators need: a hash of the record's fields, so it is the
    same on every retry and in streams.  Equal lines get equal ids; operators that
    must tell them apart use the order of rows, not the id."""
    checked = validate(df, on_bad, {*optional, *carry}, rejects)
    if "event_id" in df.columns:
        return checked
    return checked.withColumn("event_id", F.xxhash64(*[F.col(c) for c in df.columns if c not in carry]))


def _load_csv(spark: SparkSession, path: str, schema: str, stream: bool, unit: str, on_bad: str,
              optional: set[str] = frozenset(), rejects: Observation | str | None = None) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    df = (reader.schema(schema).option("sep", ",").option("header", "false")
          .option("mode", "PERMISSIVE").csv(path))
    return _finish(df.withColumn("ts", epoch_to_ts("timestamp", unit)), on_bad, optional, rejects)


def load_user_behavior(spark: SparkSession, path: str, stream: bool = False, unit: str = "s",
                       on_bad: str = "fail", rejects: Observation | str | None = None) -> DataFrame:
    """userId, itemId, categoryId, behavior, timestamp (seconds by default)."""
    return _load_csv(spark, path, USER_BEHAVIOR_SCHEMA, stream, unit, on_bad, rejects=rejects)


def load_ad_clicks(spark: SparkSession, path: str, stream: bool = False, unit: str = "ms",
                   on_bad: str = "fail", rejects: Observation | str | None = None) -> DataFrame:
    """userId, adId, province, city, timestamp (milliseconds by default)."""
    return _load_csv(spark, path, AD_CLICK_SCHEMA, stream, unit, on_bad, rejects=rejects)


def load_logins(spark: SparkSession, path: str, stream: bool = False, unit: str = "s",
                on_bad: str = "fail", rejects: Observation | str | None = None) -> DataFrame:
    """userId, ip, eventType ('fail' or anything else), timestamp (seconds)."""
    return _load_csv(spark, path, LOGIN_SCHEMA, stream, unit, on_bad, rejects=rejects)


def load_order_events(spark: SparkSession, path: str, stream: bool = False, unit: str = "ms",
                      on_bad: str = "fail", rejects: Observation | str | None = None) -> DataFrame:
    """orderId, event ('create'/'pay'), txId (empty allowed -> null), timestamp."""
    return _load_csv(spark, path, ORDER_EVENT_SCHEMA, stream, unit, on_bad, ORDER_OPTIONAL, rejects=rejects)


def load_receipts(spark: SparkSession, path: str, stream: bool = False, unit: str = "ms",
                  on_bad: str = "fail", rejects: Observation | str | None = None) -> DataFrame:
    """txId, payChannel, timestamp."""
    return _load_csv(spark, path, RECEIPT_SCHEMA, stream, unit, on_bad, rejects=rejects)


def load_market_behavior(spark: SparkSession, path: str, stream: bool = False, unit: str = "ms",
                         on_bad: str = "fail", rejects: Observation | str | None = None) -> DataFrame:
    """userId, behavior, channel, timestamp (the original generates these rows)."""
    return _load_csv(spark, path, MARKET_SCHEMA, stream, unit, on_bad, rejects=rejects)


def parse_access_log(lines: DataFrame, time_pattern: str | Sequence[str] = ACCESS_TIME_PATTERNS,
                     value: str = "value", on_bad: str = "fail",
                     rejects: Observation | str | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Space-separated ``ip userId time method url``.

    A time pattern may contain spaces and then takes as many tokens; of several
    patterns the first that parses is used (by default year first, with the time
    of day in a token of its own or behind a colon)."""
    patterns = [time_pattern] if isinstance(time_pattern, str) else list(time_pattern)
    parts = F.split(F.col(value), " ")

    def record(pattern: str) -> Column:
        n = pattern.count(" ") + 1
        text = F.array_join(F.slice(parts, 3, n), " ")
        return F.struct(F.try_to_timestamp(text, F.lit(pattern)).alias("ts"),
                        F.get(parts, F.lit(2 + n)).alias("method"), F.get(parts, F.lit(3 + n)).alias("url"))
    tries = [record(p) for p in patterns]
    rest = tries[-1]
    for r in reversed(tries[:-1]):
        rest = F.when(r["ts"].isNotNull(), r).otherwise(rest)
    parsed = lines.select(*carry, F.get(parts, F.lit(0)).alias("ip"), F.get(parts, F.lit(1)).alias("user_id"), rest.alias("__r"))
    return _finish(parsed.select(*carry, "ip", "user_id", "__r.ts", "__r.method", "__r.url"), on_bad, rejects=rejects, carry=carry)


def load_access_log(spark: SparkSession, path: str, stream: bool = False,
                    time_pattern: str | Sequence[str] = ACCESS_TIME_PATTERNS, on_bad: str = "fail",
                    rejects: Observation | str | None = None) -> DataFrame:
    """ip, userId, time, method, url."""
    reader = spark.readStream if stream else spark.read
    return parse_access_log(reader.text(path), time_pattern, on_bad=on_bad, rejects=rejects)


def parse_csv_value(values: DataFrame, schema: str, unit: str, value: str = "value", on_bad: str = "fail",
                    rejects: Observation | str | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Parse a string column of comma-separated records (e.g. Kafka values); columns in ``carry`` stay."""
    parsed = values.select(*carry, F.from_csv(F.col(value).cast("string"), schema).alias("__r")).select(*carry, "__r.*")
    optional = ORDER_OPTIONAL if schema == ORDER_EVENT_SCHEMA else frozenset()
    return _finish(parsed.withColumn("ts", epoch_to_ts("timestamp", unit)), on_bad, optional, rejects, carry)


# --------------------------------------------------------------------------- dead letters


def raw_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """``value`` with the file and block that each line is read from."""
    reader = spark.readStream if stream else spark.read
    return reader.text(path).select("value", F.col("_metadata.file_path").alias("raw_file"),
                                    F.col("_metadata.file_block_start").alias("__block"))


def numbered_lines(lines: DataFrame) -> DataFrame:
    """``value`` and ``RAW``: line, file and line number (from 1) of ``raw_lines``.

    A block of a file is read by one task from its first line to its last, so a line's place in its
    block is its running id less the block's first; the lines of the blocks before it come from a
    row per block.  Nothing is sorted but those rows."""
    ids = lines.withColumn("__id", F.monotonically_increasing_id())
    before = Window.partitionBy("raw_file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (ids.groupBy("raw_file", "__block").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__lines"))
              .withColumn("__before", F.coalesce(F.sum("__lines").over(before), F.lit(0))))
    return ids.join(blocks, ["raw_file", "__block"]).select(
        "value", F.col("value").alias("raw_line"), "raw_file",
        (F.col("__before") + F.col("__id") - F.col("__first") + 1).alias("raw_number"))


def split_rejects(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of rows parsed with ``on_bad="tag", carry=RAW``: the good ones without the carried columns, and the
    dead letters ``raw_file, raw_number, raw_line, reject_reason``.  Each line is in exactly one of them."""
    good = tagged.filter(F.col(REASON).isNull()).drop(REASON, *RAW)
    return good, tagged.filter(F.col(REASON).isNotNull()).select("raw_file", "raw_number", "raw_line", REASON)
