"""Event-time helpers: every operator works on epoch microseconds internally.

Integer arithmetic on ``BIGINT`` microseconds keeps window and gap tests exact
and inside whole-stage codegen; results are reported as epoch milliseconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

US_PER_S = 1_000_000
US_PER_MS = 1_000
DAY_S = 86_400


def floor_div(num: Column, den: int) -> Column:
    """Exact floor division of a BIGINT column by a positive constant."""
    den_l = F.lit(int(den)).cast("bigint")
    return F.call_function("div", num - F.pmod(num, den_l), den_l)


def as_event_time(df: DataFrame, col: str) -> Column:
    """``col`` as a TIMESTAMP (an instant), whatever its stored type.

    ``timestamp_ntz`` is read as UTC wall clock.  With the session in UTC this
    is a plain cast; otherwise the NTZ offset from the epoch is added to the
    epoch instant, which does not depend on the session zone.
    """
    dtype = df.schema[col].dataType
    if isinstance(dtype, TimestampType):
        return F.col(col)
    if isinstance(dtype, TimestampNTZType):
        tz = df.sparkSession.conf.get("spark.sql.session.timeZone", "UTC")
        if tz in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
            return F.col(col).cast("timestamp")
        return F.expr(f"timestamp_micros(0) + (`{col}` - TIMESTAMP_NTZ'1970-01-01 00:00:00')")
    raise TypeError(f"event-time column {col!r} has type {dtype.simpleString()}")


def epoch_us(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_micros(c)


def us_to_ms(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return floor_div(c, US_PER_MS)


def seconds_to_us(seconds: float) -> int:
    return int(round(seconds * US_PER_S))


def local_day(ts_us: Column, offset_s: int) -> Column:
    """Index of the local calendar day for a zone ``offset_s`` east of UTC."""
    return floor_div(ts_us + F.lit(seconds_to_us(offset_s)), DAY_S * US_PER_S)
