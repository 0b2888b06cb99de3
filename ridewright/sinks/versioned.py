"""Keyed tables as append-only changes that are merged when they are read.

A writer only ever adds the folder of its own job and batch, so a batch reads nothing of the table, two writers
cannot lose each other's rows, and a batch that is run again finds its folder complete and changes nothing. Each
column of a key is a register: the value with the highest version stays. A removal is a version too; what is
older than it is gone, whenever it arrives. The merge takes maxima only, so the order of batches does not matter.

``compact`` merges pending changes into the base of the parts they touch, once they are a stated share of it, and
publishes a new list of base folders. A reader takes the newest list and the changes that it does not hold yet.
Tables without a date are cut by a hash of the first key column into as many parts as their size asks for.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridewright.sinks.files import Folder

PART_BYTES = 128 << 20
COMPACT_SHARE = 0.2
NO_PART = "none"
VERSION = T.StructType(
    [
        T.StructField("at", T.TimestampType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("by", T.StringType()),
        T.StructField("tie", T.LongType()),
    ]
)
# Of one instant, a set comes after a put and a removal after both.
PUT, SET, REMOVE = range(3)


@dataclass(frozen=True)
class Snapshot:
    """What a list of base folders says: a folder for each part, and the last batch it holds of each job."""

    number: int = 0
    buckets: int = 1
    parts: Mapping[str, str] = field(default_factory=dict)
    held: Mapping[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class VersionedTable:
    spark: SparkSession
    path: str
    schema: T.StructType
    keys: Sequence[str]
    dated: str | None = None  # the column whose value names the part; else a hash of the key does
    part_bytes: int = PART_BYTES

    @cached_property
    def _folder(self) -> Folder:
        return Folder(self.spark, self.path)

    @property
    def values(self) -> list[str]:
        return [c for c in self.schema.names if c not in self.keys]

    @property
    def _stored(self) -> T.StructType:
        marks = ["_put", "_gone", *(f"_v_{c}" for c in self.values)]
        return T.StructType([*self.schema.fields, *(T.StructField(m, VERSION) for m in marks)])

    # -- writing

    def put(self, rows: DataFrame, at: str | Column, job: str, batch: int) -> None:
        """Whole rows, each valid from ``at``; a later put or set of a column replaces its value."""
        self._append(self._puts(rows, at, job, batch), job, batch)

    def set(self, rows: DataFrame, at: str | Column, columns: Mapping[str, Column], job: str, batch: int) -> None:
        """Single columns, written over the columns of ``rows``; a null changes nothing, nor does an unknown key."""
        self.set_all([(rows, at, columns)], job, batch)

    def set_all(
        self, groups: Sequence[tuple[DataFrame, str | Column, Mapping[str, Column]]], job: str, batch: int
    ) -> None:
        """Several sets as one batch, each with its own instants."""
        changes = [self._sets(*group, job, batch) for group in groups]
        self._append(reduce(DataFrame.unionByName, changes), job, batch)

    def _sets(self, rows: DataFrame, at: str | Column, columns: Mapping[str, Column], job: str, batch: int) -> DataFrame:
        stamp = _version(rows, at, SET, job, batch)
        changed = [c for c in columns if c != self.dated]
        fresh = rows.select(
            *self._identity(rows),
            *[columns[c].cast(self.schema[c].dataType).alias(c) for c in changed],
            stamp.alias("_stamp"),
        )
        marks = [F.when(F.col(c).isNotNull(), F.col("_stamp")).alias(f"_v_{c}") for c in changed]
        return self._complete(fresh.select("*", *marks))

    def remove(self, rows: DataFrame, at: str | Column, job: str, batch: int) -> None:
        """Keys that are gone from ``at`` on; rows put later stay."""
        self._append(self._removals(rows, at, job, batch), job, batch)

    def replace_part(self, value: object, rows: DataFrame, at: Column, job: str, batch: int) -> None:
        """Put ``rows``, and remove the other rows that the part of ``value`` has now."""
        now = self.read(parts=[value])
        gone = now.join(rows.select(*self.keys), list(self.keys), "left_anti")
        both = self._puts(rows, at, job, batch).unionByName(self._removals(gone, at, job, batch))
        self._append(both, job, batch)

    def _identity(self, rows: DataFrame, names: Sequence[str] | None = None) -> list[Column]:
        wanted = names or [*self.keys, *([self.dated] if self.dated and self.dated not in self.keys else [])]
        return [F.col(c).cast(self.schema[c].dataType).alias(c) for c in wanted]

    def _puts(self, rows: DataFrame, at: str | Column, job: str, batch: int) -> DataFrame:
        stamp = _version(rows, at, PUT, job, batch)
        typed = rows.select(*[F.col(c).cast(self.schema[c].dataType).alias(c) for c in self.schema.names], stamp.alias("_put"))
        return self._complete(typed.select("*", *[F.col("_put").alias(f"_v_{c}") for c in self.values]))

    def _removals(self, rows: DataFrame, at: str | Column, job: str, batch: int) -> DataFrame:
        return self._complete(rows.select(*self._identity(rows), _version(rows, at, REMOVE, job, batch).alias("_gone")))

    def _complete(self, changes: DataFrame) -> DataFrame:
        have = set(changes.columns)
        return changes.select(
            *[F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in self._stored.fields]
        )

    def _append(self, changes: DataFrame, job: str, batch: int) -> None:
        name = f"changes/job={job}/batch={batch}"
        now = self.snapshot()
        if batch <= now.held.get(job, -1) or self._folder.complete(name):
            return  # the first attempt stays
        self._write(self._placed(changes, now.buckets), name)

    def _placed(self, rows: DataFrame, buckets: int) -> DataFrame:
        return rows.withColumns({"buckets": F.lit(0 if self.dated else buckets), "part": self._part(buckets)})

    def _part(self, buckets: int) -> Column:
        if self.dated:
            return F.coalesce(F.col(self.dated).cast("string"), F.lit(NO_PART))
        return F.pmod(F.xxhash64(self.keys[0]), F.lit(buckets)).cast("string")

    def _write(self, placed: DataFrame, name: str) -> None:
        # rebalancing gives a part few files, and a crowded one several
        rows = placed.hint("rebalance", "part")
        rows.write.mode("overwrite").partitionBy("buckets", "part").parquet(f"{self.path}/{name}")

    # -- reading

    def snapshot(self) -> Snapshot:
        """The newest published list; one that its writer did not finish is passed over."""
        for name in reversed(self._folder.names("versions")):
            try:
                return Snapshot(**json.loads(self._folder.read(f"versions/{name}")))
            except (ValueError, TypeError):
                continue
        return Snapshot()

    def _pending(self, now: Snapshot) -> list[tuple[str, int]]:
        """Complete batches that the list does not hold."""
        found = []
        for job in self._folder.names("changes"):
            for batch in self._folder.names(f"changes/{job}"):
                number = int(batch.removeprefix("batch="))
                name = job.removeprefix("job=")
                if number > now.held.get(name, -1) and self._folder.complete(f"changes/{job}/{batch}"):
                    found.append((name, number))
        return found

    def _change_parts(self, pending: list[tuple[str, int]]) -> dict[tuple[int, str], list[str]]:
        """Change folders of each (buckets, part)."""
        out: dict[tuple[int, str], list[str]] = {}
        for job, batch in pending:
            top = f"changes/job={job}/batch={batch}"
            for cut in self._folder.names(top):
                for part in self._folder.names(f"{top}/{cut}"):
                    place = int(cut.removeprefix("buckets=")), part.removeprefix("part=")
                    out.setdefault(place, []).append(f"{top}/{cut}/{part}")
        return out

    def exists(self) -> bool:
        return self._folder.exists("changes") or self._folder.exists("versions")

    def read(self, keys: DataFrame | None = None, parts: Sequence[object] | None = None) -> DataFrame:
        """The live rows; with ``keys`` or ``parts`` only files are read that may hold them.

        ``keys`` has the first key column and perhaps others, or the dated column of a dated table, whose days
        are then read whole.
        ``parts`` are values of the dated column.
        """
        now = self.snapshot()
        pending = self._change_parts(self._pending(now))
        cuts = {now.buckets, *(cut for cut, _ in pending)}
        wanted = self._wanted(keys, parts, cuts)
        changed = [p for place, paths in pending.items() if wanted is None or place in wanted for p in paths]
        touched = {place for place in pending if wanted is None or place in wanted}
        base, merged = [], []
        for part, folder in now.parts.items():
            cut = 0 if self.dated else now.buckets
            if wanted is None or (cut, part) in wanted:
                path = f"base/{folder}/buckets={cut}/part={part}"
                # a hashed table whose number of parts has changed since may have its keys in any change
                apart = (cut, part) not in touched and all(c == cut for c, _ in touched)
                (base if apart else merged).append(path)
        rows = self._live(self._files(base))
        if changed:
            rows = rows.unionByName(self._live(self._merge(self._files(merged + changed))))
        if keys is not None and not self.dated:
            given = [k for k in self.keys if k in keys.columns]
            rows = rows.join(keys.select(*self._identity(keys, given)).distinct(), given, "left_semi")
        return rows

    def _wanted(
        self, keys: DataFrame | None, parts: Sequence[object] | None, cuts: set[int]
    ) -> set[tuple[int, str]] | None:
        if parts is not None:
            return {(0, NO_PART if p is None else str(p)) for p in parts}
        if keys is None:
            return None
        if self.dated:  # as many as there are days
            return {(0, r[0]) for r in keys.select(self._part(1)).distinct().collect()}
        typed = keys.select(*self._identity(keys, self.keys[:1]))
        # as many as there are parts
        names = typed.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), self._part(c).alias("p")) for c in cuts])))
        return {(r.c, r.p) for r in names.select("col.*").distinct().collect()}

    def _files(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self._stored)
        return self.spark.read.schema(self._stored).parquet(*[f"{self.path}/{p}" for p in paths])

    def _merge(self, rows: DataFrame) -> DataFrame:
        """One row for each key, with the newest value of every column."""
        newest = [F.max(m).alias(m) for m in ("_put", "_gone")]
        for c in self.values:
            newest += [F.max_by(c, f"_v_{c}").alias(c), F.max(f"_v_{c}").alias(f"_v_{c}")]
        by = [*self.keys]
        return rows.groupBy(*by).agg(*newest).select(*self._stored.names)

    def _live(self, merged: DataFrame) -> DataFrame:
        gone = F.col("_gone")
        alive = merged.where(F.col("_put").isNotNull() & (gone.isNull() | (F.col("_put") > gone)))
        kept = [F.when(gone.isNull() | (F.col(f"_v_{c}") > gone), F.col(c)).alias(c) for c in self.values]
        return alive.select(*self.keys, *kept).select(*self.schema.names)

    # -- upkeep

    def compact(self, share: float = COMPACT_SHARE, forget: Column | None = None) -> bool:
        """Merge pending changes into the base if they are at least ``share`` of the parts they touch.

        Only those parts are rewritten, unless the table has outgrown the number of its parts. Removals stay, so
        that late changes cannot bring a key back, except those before ``forget``.
        """
        now = self.snapshot()
        pending = self._pending(now)
        places = self._change_parts(pending)
        if not places:
            return False
        changes = [p for paths in places.values() for p in paths]
        fresh = sum(self._folder.size(p) for p in changes)
        cut = 0 if self.dated else now.buckets
        size = {p: self._folder.size(f"base/{f}/buckets={cut}/part={p}") for p, f in now.parts.items()}
        resized = not self.dated and sum(size.values()) + fresh > 2 * now.buckets * self.part_bytes
        buckets = now.buckets
        while resized and sum(size.values()) + fresh > buckets * self.part_bytes:
            buckets *= 2
        touched = set(now.parts) if resized or any(c != cut for c, _ in places) else {p for _, p in places} & set(now.parts)
        if not resized and fresh < share * sum(size[p] for p in touched):
            return False
        old = [f"base/{now.parts[p]}/buckets={cut}/part={p}" for p in sorted(touched)]
        merged = self._merge(self._files(old + changes))
        if forget is not None:
            merged = merged.where(F.col("_gone").isNull() | (F.col("_put") > F.col("_gone")) | (F.col("_gone.at") >= forget))
        number = now.number + 1
        folder = f"{number:08d}-{uuid.uuid4().hex}"
        self._write(self._placed(merged, buckets), f"base/{folder}")
        written = {p.removeprefix("part=") for p in self._folder.names(f"base/{folder}/buckets={0 if self.dated else buckets}")}
        parts = {p: f for p, f in now.parts.items() if p not in touched} | dict.fromkeys(sorted(written), folder)
        held = dict(now.held)
        for job, batch in pending:
            held[job] = max(batch, held.get(job, -1))
        fact = {"number": number, "buckets": buckets, "parts": parts, "held": held}
        if not self._folder.claim(f"versions/{number:08d}.json", json.dumps(fact)):
            self._folder.remove(f"base/{folder}")  # another compaction was first
            return False
        return True

    def vacuum(self, keep: int = 2) -> None:
        """Remove what the last ``keep`` lists do not need; readers of older ones must have ended."""
        names = self._folder.names("versions")
        lists = []
        for name in names[-keep:]:
            try:
                lists.append(Snapshot(**json.loads(self._folder.read(f"versions/{name}"))))
            except (ValueError, TypeError):
                return
        if len(lists) < keep:
            return
        used = {f for s in lists for f in s.parts.values()}
        newest = f"{lists[-1].number:08d}"
        for folder in self._folder.names("base"):
            # a folder with a higher number belongs to a compaction that still runs
            if folder not in used and folder[:8] <= newest:
                self._folder.remove(f"base/{folder}")
        for job, batch in lists[0].held.items():
            for name in self._folder.names(f"changes/job={job}"):
                if int(name.removeprefix("batch=")) <= batch:
                    self._folder.remove(f"changes/job={job}/{name}")
        for name in names[:-keep]:
            self._folder.remove(f"versions/{name}")


def _version(rows: DataFrame, at: str | Column, rank: int, job: str, batch: int) -> Column:
    """Instant, kind, writer and, among equal ones, a hash of the row."""
    instant = F.col(at) if isinstance(at, str) else at
    return F.struct(
        instant.cast("timestamp").alias("at"),
        F.lit(rank).alias("rank"),
        F.lit(f"{job}/{batch:012d}").alias("by"),
        F.xxhash64(*rows.columns).alias("tie"),
    )
