"""The stored tables of one deployment, and how each is keyed and cut."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridewright import schemas
from ridewright.sinks import tables
from ridewright.sinks.files import Folder
from ridewright.sinks.versioned import VersionedTable

KEYS = {
    "vehicles": ["vehicle_id"],
    "owners": ["owner_id"],
    "riders": ["rider_id"],
    "rates": ["currency_code"],
    "active_rides": ["rider_id", "ride_id"],
    "authorisations": ["ride_id"],
    "rides_summary": ["ride_id"],
    "rides_ended": ["ride_id"],
    "vehicle_stats_daily": ["vehicle_id", "date"],
    "owner_stats_daily": ["owner_id", "date"],
    "payments": ["ride_id"],
    "transfers": ["transfer_id"],
}
DATED = {
    "rides_summary": "effective_date",
    "rides_ended": "end_day",
    "vehicle_stats_daily": "date",
    "owner_stats_daily": "date",
}
EXPIRING = ["job_states", "search_results"]


def ride_key(rider: Column, vehicle: Column, start: Column) -> Column:
    """A ride is one rider on one vehicle from one instant."""
    return F.concat_ws("/", rider, vehicle, F.unix_millis(start.cast("timestamp")).cast("string"))


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    folder: str

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, self.path(name), schemas.TABLES[name], KEYS[name], DATED.get(name))

    def read(self, name: str, keys: DataFrame | None = None, parts: Sequence[object] | None = None) -> DataFrame:
        """A table, none of it before its first write; ``keys`` or ``parts`` restrict the files that are read."""
        return self.table(name).read(keys, parts)

    def put(self, name: str, rows: DataFrame, at: str | Column, job: str, batch: int) -> None:
        self.table(name).put(rows, at, job, batch)

    def set(
        self, name: str, rows: DataFrame, at: str | Column, columns: Mapping[str, Column], job: str, batch: int
    ) -> None:
        self.table(name).set(rows, at, columns, job, batch)

    def remove(self, name: str, rows: DataFrame, at: str | Column, job: str, batch: int) -> None:
        self.table(name).remove(rows, at, job, batch)

    def upkeep(self, now: datetime) -> None:
        """Compact what has grown, and remove what no reader needs any more or what has expired (UTC)."""
        for name in KEYS:
            if self.table(name).exists():
                self.table(name).compact()
                self.table(name).vacuum()
        for name in EXPIRING:
            tables.remove_expired(self.spark, self.path(name), now)

    def stage(self, job: str, batch_id: int, df: DataFrame) -> DataFrame:
        """The rows a micro-batch computed, written once per batch id and read back.

        A repeated batch gets the rows of the first attempt that was finished, whatever was stored since.
        """
        path = f"{self.folder}/staged/{job}/batch={batch_id}"
        if not Folder(self.spark, path).complete():
            df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def send(self, job: str, batch_id: int, messages: DataFrame) -> None:
        """Messages (topic, value) of a micro-batch; a repeated batch replaces its own."""
        messages.write.mode("overwrite").partitionBy("topic").parquet(
            f"{self.folder}/outbox/{job}/batch={batch_id}"
        )

    def land(self, name: str, job: str, batch_id: int, rows: DataFrame) -> None:
        """Rows for a stream that reads ``path(name)``; a batch that was landed is not landed again."""
        path = f"{self.path(name)}/{job}/batch={batch_id}"
        if not Folder(self.spark, path).complete():
            rows.write.mode("overwrite").parquet(path)

    def landed(self, name: str, schema: str) -> DataFrame:
        """What was landed under a name, as a stream."""
        if not Folder(self.spark, self.path(name)).exists():
            self.spark.createDataFrame([], schema).write.mode("append").parquet(f"{self.path(name)}/none")
        return self.spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(self.path(name))

    def append_ledger(self, name: str, entries: DataFrame, job: str, batch_id: int) -> None:
        entries.write.mode("overwrite").parquet(f"{self.path(name)}/job={job}/batch={batch_id}")

    def ledger(self, name: str) -> DataFrame:
        """Ledger entries of all jobs; none before the first one."""
        stored = tables.stored(self.spark, self.path(name))
        if stored is None:
            key = "owner_id" if name == "owner_ledger" else "rider_id"
            return self.spark.createDataFrame([], f"{key} string, amount decimal(18,2)")
        return stored.drop("job", "batch")
