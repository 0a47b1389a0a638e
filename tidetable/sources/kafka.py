"""Kafka topics: scans and the decoding of their ``value`` column.

Reading a topic needs Spark's Kafka connector on the classpath. Everything after the scan is plain column work and
takes any frame shaped like the connector's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidetable.functions.text import pair_text


def topic_stream(
    spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None, **options: str
) -> DataFrame:
    """The topic from its earliest offset on; ``max_offsets`` bounds one micro-batch."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
    )
    return (reader.option("maxOffsetsPerTrigger", max_offsets) if max_offsets else reader).load()


def json_rows(messages: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """JSON payloads as rows of the declared schema; numbers may fill text columns, ISO times timestamps."""
    return messages.select(F.from_json(F.col(value).cast("string"), schema).alias("row")).select("row.*")


def json_table(messages: DataFrame, schema: str, name: str, value: str = "value") -> DataFrame:
    """Declare a table over JSON messages: decode and register it under ``name`` for SQL."""
    rows = json_rows(messages, schema, value)
    rows.createOrReplaceTempView(name)
    return rows


def pair_messages(df: DataFrame, first: str, second: str) -> DataFrame:
    """The outgoing ``value`` column ``(word,total)``."""
    return df.select(pair_text(first, second).alias("value"))
