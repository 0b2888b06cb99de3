"""Keyed table changes: upsert, partial update, delete, expiry and ledgers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridewright.functions import money
from ridewright.operators.lookup import latest_per_key


def merge_latest(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], version: Sequence[str]
) -> DataFrame:
    """Existing rows overwritten by incoming rows of the same key; the highest version wins."""
    return latest_per_key(existing.unionByName(incoming), keys, version)


def apply_update(
    current: DataFrame, delta: DataFrame, keys: Sequence[str], columns: Mapping[str, Column]
) -> DataFrame:
    """Partial-column update.

    ``columns`` maps a column of ``current`` to the expression that replaces it, written over the
    columns of ``delta``; a null result keeps the current value. ``delta`` has one row per key.
    Keys that appear only in ``delta`` are ignored.
    """
    changes = delta.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        *[value.alias(f"_new_{name}") for name, value in columns.items()],
    )
    match = [current[k] == changes[f"_key_{k}"] for k in keys]
    joined = current.join(changes, match, "left")
    return joined.select(
        *[
            F.coalesce(F.col(f"_new_{c}"), current[c]).alias(c) if c in columns else current[c]
            for c in current.columns
        ]
    )


def delete_keys(current: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``current`` whose key is not in ``gone``."""
    return current.join(gone.select(*keys), list(keys), "left_anti")


def with_expiry(df: DataFrame, written_at: str, seconds: int) -> DataFrame:
    return df.withColumn("expires_at", F.col(written_at) + F.expr(f"interval {seconds} seconds"))


def live_rows(df: DataFrame, as_of: Column) -> DataFrame:
    """Rows that have not expired at ``as_of``."""
    return df.where(F.col("expires_at") > as_of)


def ledger_sum(entries: DataFrame, key: str, amount: str, total: str) -> DataFrame:
    """Counter value per key: each entry is truncated to hundredths, then summed as integers."""
    return entries.groupBy(key).agg(F.sum(money.to_cents(F.col(amount))).alias(total))


def position(base: Column, delta_cents: Column) -> Column:
    """Token balance: the snapshot (0 when never read) plus the counter."""
    return (F.coalesce(base, F.lit(0).cast(money.MONEY)) + money.from_cents(delta_cents)).cast(
        "decimal(22,2)"
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)
