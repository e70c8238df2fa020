"""Message sources and the topic sink.

The reference reads impressions from a Kafka topic. ``message_stream`` reads
the same ``value`` strings from Kafka when the connector is on the classpath,
or from a folder of text files (one JSON message per line) otherwise; both
give ``key``, ``value`` and ``arrival`` (broker or batch time).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def message_stream(spark: SparkSession, kind: str = "text", path: str | None = None,
                   servers: str | None = None, topic: str | None = None,
                   options: dict | None = None, batch_limit: int | None = None) -> DataFrame:
    """``batch_limit`` bounds what a micro-batch takes in: offsets of a topic,
    or files. A job that starts behind its topic catches up in batches of that
    size instead of one that holds everything."""
    opts = dict(options or {})
    if batch_limit is not None:
        opts["maxOffsetsPerTrigger" if kind == "kafka" else "maxFilesPerTrigger"] = str(batch_limit)
    if kind == "kafka":
        raw = (spark.readStream.format("kafka")
               .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
               .option("startingOffsets", opts.pop("startingOffsets", "earliest"))
               .options(**opts).load())
        return raw.select(F.col("key").cast("string").alias("key"),
                          F.col("value").cast("string").alias("value"),
                          F.col("timestamp").alias("arrival"))
    if kind == "text":
        raw = spark.readStream.options(**opts).text(path)
        return raw.select(F.lit(None).cast("string").alias("key"), F.col("value"),
                          F.current_timestamp().alias("arrival"))
    if kind == "table":  # messages kept as rows: key, value and, if present, arrival
        raw = spark.readStream.schema("key string, value string, arrival timestamp").options(**opts).parquet(path)
        return raw.select("key", "value", F.coalesce("arrival", F.current_timestamp()).alias("arrival"))
    raise ValueError(f"unknown source kind {kind!r}")


def topic_sink_options(servers: str, topic: str, batch_bytes: int = 16384,
                       linger_ms: int = 10) -> dict:
    """Options of a ``kafka`` sink. The producer sends a batch when it has so
    many bytes or after ``linger_ms``, as the reference's did after 25
    messages or 10 ms."""
    return {"kafka.bootstrap.servers": servers, "topic": topic,
            "kafka.batch.size": str(batch_bytes), "kafka.linger.ms": str(linger_ms)}


def to_topic(messages: DataFrame) -> DataFrame:
    """Rows ready for a topic sink: ``value`` only (no key), as the producer sends."""
    return messages.select(F.col("value").cast("string").alias("value"))


def write_topic(messages: DataFrame, checkpoint: str, kind: str = "kafka", path: str | None = None,
                options: dict | None = None, trigger: dict | None = None):
    """Start the query that publishes a stream of messages: to a topic with
    ``topic_sink_options``, or to a folder of text files."""
    out = to_topic(messages).writeStream.option("checkpointLocation", checkpoint).options(**(options or {}))
    out = out.format("kafka") if kind == "kafka" else out.format("text").option("path", path)
    return out.trigger(**(trigger or {"processingTime": "1 second"})).start()
