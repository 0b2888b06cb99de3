"""Starting streams: checkpoints and outputs live in the shared folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ridewright.session import ROCKSDB_PROVIDER, scratch_path

# A tick of this instant says that nothing more will come; no row has it.
CLOSING = datetime(9000, 1, 1)


def timed(df: DataFrame, column: str, delay: str, ticks: DataFrame | None = None) -> DataFrame:
    """Rows with a watermark on ``column``. ``ticks`` (tick timestamp) push it on while no rows come.

    The rows that ticks become are dropped above the watermark. Every column is made to depend on its column
    there, since conditions on other columns would be applied below it and take the ticks away too early.
    """
    rows = df.withColumn(column, F.col(column).cast("timestamp"))
    if ticks is not None:
        rows = rows.unionByName(ticks.select(F.col("tick").alias(column)), allowMissingColumns=True)
    marked = rows.withWatermark(column, delay)
    if ticks is None:
        return marked
    before = F.col(column) < F.lit(CLOSING).cast("timestamp")
    return marked.select(*[c if c == column else F.when(before, F.col(c)).alias(c) for c in marked.columns]).where(before)


def landed_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """Ticks that somebody lands in a folder, as a stream."""
    return spark.readStream.schema("tick timestamp").parquet(folder)


def land_tick(spark: SparkSession, folder: str, at: datetime | None) -> None:
    """Land a tick; with None only make the folder."""
    rows = [(at,)] if at else []
    spark.createDataFrame(rows, "tick timestamp").coalesce(1).write.mode("append").parquet(folder)


def use_rocksdb(spark: SparkSession) -> None:
    """Keep operator state on disk next to the executor; state then outgrows memory safely."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


def start_parquet(df: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Append rows to a Parquet folder; without ``interval`` process what is there and stop."""
    writer = (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def start_batches(
    df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Run ``handle(rows, batch id)`` per micro-batch; it must bear being repeated for an id."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        df.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def drain(build: Callable[[DataFrame], DataFrame], label: str) -> DataFrame:
    """Run the stream that ``build`` makes of a stream of ticks over everything available, and read its rows.

    A closing tick then pushes the watermark past the last row, so that what waits for it comes out too.
    """
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, label)
    ticks = f"{path}-ticks"
    land_tick(spark, ticks, None)
    out = build(landed_ticks(spark, ticks))
    start_parquet(out, path, f"{path}-checkpoint").awaitTermination()
    land_tick(spark, ticks, CLOSING)
    start_parquet(out, path, f"{path}-checkpoint").awaitTermination()
    return spark.read.schema(out.schema).parquet(path)
