"""Kafka source and sink for the text records.

The Kafka connector jar is not part of a plain PySpark install; these return
the configured reader / writer and fail only when started without it.  Tests
feed the same parser (``parse_csv_value``) from files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.sources.text import USER_BEHAVIOR_SCHEMA, parse_csv_value


def kafka_options(bootstrap_servers: str, topic: str, group_id: str | None = None,
                  starting_offsets: str = "latest") -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic,
            "startingOffsets": starting_offsets}
    if group_id:
        opts["kafka.group.id"] = group_id
    return opts


def kafka_source(spark: SparkSession, bootstrap_servers: str, topic: str = "topic-items",
                 group_id: str | None = "consumer-hotitems", schema: str = USER_BEHAVIOR_SCHEMA,
                 unit: str = "s", starting_offsets: str = "latest", on_bad: str = "fail",
                 rejects: str | None = None) -> DataFrame:
    """Stream of parsed records from a topic whose values are CSV lines; bad values follow the
    loaders' policy and are counted in the progress events under ``rejects``."""
    raw = (spark.readStream.format("kafka")
           .options(**kafka_options(bootstrap_servers, topic, group_id, starting_offsets)).load())
    return parse_csv_value(raw.select(F.col("value").cast("string").alias("value")), schema, unit,
                           on_bad=on_bad, rejects=rejects)


def kafka_sink(lines: DataFrame, bootstrap_servers: str, topic: str,
               checkpoint: str | None = None, value: str = "value") -> DataStreamWriter | None:
    """Write one record per row, value only (the original's file-to-topic helper).

    Batch frames are written at once (returns None); streaming frames return
    the configured writer (start it with ``.start()``).
    """
    out = lines.select(F.col(value).cast("string").alias("value"))
    if out.isStreaming:
        w = (out.writeStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
             .option("topic", topic))
        return w.option("checkpointLocation", checkpoint) if checkpoint else w
    (out.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
     .option("topic", topic).save())
    return None
