"""Outgoing messages. Rows carry ``topic`` and ``value``; keys stay null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ridewright.functions import messages

COMMAND_TOPIC_PREFIX = "iot-commands-"


def to_topic(df: DataFrame, topic: str | Column, value: Column) -> DataFrame:
    topic = F.lit(topic) if isinstance(topic, str) else topic
    return df.select(topic.alias("topic"), value.alias("value"))


def device_commands(df: DataFrame) -> DataFrame:
    """One command per row, addressed to the topic of the device's vendor."""
    return to_topic(
        df,
        F.concat(F.lit(COMMAND_TOPIC_PREFIX), F.col("vendor")),
        messages.to_message(
            deviceId=F.col("device_id"), vendor=F.col("vendor"), command=F.col("command")
        ),
    )


def write_batch(df: DataFrame, servers: str) -> None:
    df.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def write_stream(df: DataFrame, servers: str, checkpoint: str) -> StreamingQuery:
    return (
        df.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
        .start()
    )
