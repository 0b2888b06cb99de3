"""Rows that expire, and ledgers, on plain Parquet. Keyed tables are in :mod:`ridewright.sinks.versioned`."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ridewright.operators import keyed
from ridewright.sinks.files import Folder

# Expiring rows are kept in folders by the hour until which they live, in UTC.
HOUR_SQL, HOUR_PYTHON = "yyyyMMddHH", "%Y%m%d%H"


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows at ``path``, or None before their first write."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _hour(instant: Column) -> Column:
    return F.date_format(instant.cast("timestamp"), HOUR_SQL)


def write_expiring(rows: DataFrame, path: str, written_at: str, seconds: int, job: str, batch: int) -> None:
    """Rows that readers stop seeing ``seconds`` after they were written; a repeated batch replaces its own."""
    stamped = keyed.with_expiry(rows, written_at, seconds)
    placed = stamped.withColumn("until", _hour(F.col("expires_at")))
    placed.write.mode("overwrite").partitionBy("until").parquet(f"{path}/job={job}/batch={batch}")


def live(spark: SparkSession, path: str, as_of: Column, schema: str) -> DataFrame:
    """Rows of ``schema`` that have not expired at ``as_of``; folders of past hours are not read."""
    marks = "expires_at timestamp, job string, batch bigint, until string"
    if not Folder(spark, path).names():
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(f"{schema}, {marks}").parquet(path).where(F.col("until") >= _hour(as_of))
    return keyed.live_rows(rows, as_of).drop("expires_at", "job", "batch", "until")


def remove_expired(spark: SparkSession, path: str, now: datetime) -> int:
    """Remove the batches of which every row has expired before the hour of ``now`` (UTC); returns their number."""
    folder, hour, removed = Folder(spark, path), now.strftime(HOUR_PYTHON), 0
    for job in folder.names():
        for batch in folder.names(job):
            name = f"{job}/{batch}"
            hours = [h.removeprefix("until=") for h in folder.names(name)]
            if folder.complete(name) and all(h < hour for h in hours):
                folder.remove(name)
                removed += 1
    return removed


def append_ledger(entries: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Append counter entries; a repeated micro-batch replaces its own folder instead of adding."""
    if batch_id is None:
        entries.write.mode("append").parquet(path)
    else:
        entries.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def counter(spark: SparkSession, path: str, key: str, amount: str) -> DataFrame:
    return keyed.ledger_sum(spark.read.parquet(path), key, amount, "delta_cents")
