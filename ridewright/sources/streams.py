"""Message streams. Kafka in production; landed files stand in where no broker is reachable."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridewright.functions import messages

# Topics read by the jobs.
TOPICS = [
    "unlock-vehicle",
    "lock-vehicle",
    "end-ride",
    "garage-vehicle",
    "ungarage-vehicle",
    "cordon-vehicle",
    "uncordon-vehicle",
    "cordon-garage-vehicle",
    "ungarage-uncordon-vehicle",
    "search-vehicles",
    "iot-updates",
    "update-balance",
    "token-payment",
]


def kafka_messages(
    spark: SparkSession, servers: str, topic: str, max_offsets_per_trigger: int = 5_000_000
) -> DataFrame:
    """(body, ts) of committed messages; offsets live in the query's checkpoint.

    Bodies are UTF-8 text whether the producer wrote text or bytes. ``ts`` is the broker time, for
    payloads without a time of their own.
    """
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("kafka.isolation.level", "read_committed")
        .option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        .load()
    )
    return raw.select(F.col("value").cast("string").alias("body"), F.col("timestamp").alias("ts"))


def landed_rows(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet"
) -> DataFrame:
    """Parquet files of a folder as a stream, a file at a time."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", 1)
        .parquet(folder)
    )


def landed_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Text files of a folder as a stream of message bodies, a line each."""
    return spark.readStream.option("maxFilesPerTrigger", 1).text(folder).toDF("body")


def decode(df: DataFrame, body: str, schema: T.StructType, on_error: str = "dead_letter") -> DataFrame:
    """Add ``message`` and ``dead``: fields of ``schema`` only, other wire fields are ignored.

    ``on_error="dead_letter"`` keeps malformed bodies with ``dead`` set; ``"fail"`` stops the job
    on the first one.
    """
    if on_error == "fail":
        return df.withColumn("message", messages.from_message(F.col(body), schema, "FAILFAST")).withColumn(
            "dead", F.lit(False)
        )
    parsed = df.withColumn("message", messages.from_message(F.col(body), schema))
    broken = F.col("message").isNull() | F.col(f"message.{messages.CORRUPT}").isNotNull()
    return parsed.withColumn("dead", broken)


def good(decoded: DataFrame) -> DataFrame:
    """Well-formed messages as flat columns."""
    fields = [f.name for f in decoded.schema["message"].dataType.fields if f.name != messages.CORRUPT]
    rest = [c for c in decoded.columns if c not in ("message", "dead")]
    return decoded.where(~F.col("dead")).select(
        *[c for c in rest if c not in fields], *[F.col(f"message.{f}").alias(f) for f in fields]
    )


def dead_letters(decoded: DataFrame, body: str) -> DataFrame:
    return decoded.where("dead").select(body)
