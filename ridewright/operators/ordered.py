"""Order-dependent work per key, spread over tasks even when one key holds most of the rows.

Ordinary keys are hashed to a partition, sorted there and streamed through a small step
function. Keys beyond a row limit are cut into range partitions ("blocks") instead: each block is
summarised on its own, the short list of summaries is walked once per key to find the state at
each block's start, and the blocks are then replayed in parallel from those states.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridewright.session import cut_lineage, scratch_path

# Above this many rows a key is no longer streamed through one task.
MAX_ROWS_PER_KEY = 1_000_000
BLOCK_ROWS = 250_000
# Blocks grow beyond that size rather than past this number; they are streamed, not held.
MAX_BLOCKS = 20_000

ARROW_TYPES = {
    "int": pa.int32(),
    "bigint": pa.int64(),
    "array<int>": pa.list_(pa.int32()),
    "array<bigint>": pa.list_(pa.int64()),
}


def split_hot(
    df: DataFrame, key: str, max_rows: int, counted: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None, int]:
    """(rows of ordinary keys, rows of hot keys or None, hot row count).

    Runs one pre-aggregated count over the key column, of ``counted`` if given: a frame with at
    least the rows of ``df`` that is cheaper to count. There are at most ``rows / max_rows`` hot
    keys; their list is a frame, never a driver-side list.
    """
    hot = (df if counted is None else counted).groupBy(key).count().where(F.col("count") > max_rows)
    hot_rows = hot.agg(F.sum("count")).first()[0]
    if not hot_rows:
        return df, None, 0
    keys = cut_lineage(hot.select(key))
    return df.join(keys, key, "left_anti"), df.join(keys, key, "left_semi"), hot_rows


def hashed_and_sorted(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """All rows of a key in one partition, sorted by key and ``order``."""
    return df.repartition(*keys).sortWithinPartitions(*keys, *order)


def cut_into_blocks(
    df: DataFrame, key: str, order: Sequence[str], rows: int, block_rows: int
) -> DataFrame:
    """Range-partition by key and order, number the partitions, and write them as a table.

    Block numbers must not move when a lost task is run again, and reading some blocks should not
    touch the others: the table is partitioned by block and lives in the shared folder.
    """
    spark = df.sparkSession
    parts = min(MAX_BLOCKS, max(2, ceil(rows / block_rows)))
    cut = df.repartitionByRange(parts, key, *order).withColumn("block", F.spark_partition_id())
    path = scratch_path(spark, "blocks")
    cut.write.partitionBy("block").parquet(path)
    return spark.read.schema(cut.schema).parquet(path)


def _changes(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    """Whether a row's key differs from the one before it; the first row's does."""
    out = np.zeros(batch.num_rows, bool)
    out[0] = True
    for name in names:
        number = batch.column(name).dictionary_encode(null_encoding="encode").indices.to_numpy()
        out[1:] |= number[1:] != number[:-1]
    return out


def stream_rows(
    df: DataFrame,
    keys: Sequence[str],
    advance: Callable,
    adds: Mapping[str, str],
    keep: Sequence[str],
) -> DataFrame:
    """Pass the sorted rows of each partition through ``advance``, one Arrow batch at a time.

    ``advance(carry, first, column)`` gets what it returned last, an array of flags telling where a
    new key begins, and a function that gives a column of the batch. It returns the new carry and
    the values of each added column (``adds``: name to type). Columns in ``keep`` travel along
    untouched. Memory is bounded by one batch, however many rows a key has.
    """
    names, kept, added = list(keys), list(keep), list(adds)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in kept] + [f"`{c}` {t}" for c, t in adds.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry, last = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            first = _changes(batch, names)
            head, tail = ([batch.column(n)[at].as_py() for n in names] for at in (0, -1))
            first[0] = head != last
            last = tail
            carry, columns = advance(carry, first, batch.column)
            made = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + made, [*kept, *added]
            )

    return df.mapInArrow(run, schema)


def stream_summaries(
    df: DataFrame, keys: Sequence[str], step: Callable, adds: Mapping[str, str]
) -> DataFrame:
    """One row per run of equal keys in the sorted rows of each partition.

    ``step(carry, batch)`` takes None or its last result and rows of one key, and returns one value
    per added column; what it returned last is the key's row. Only one batch is held at a time.
    """
    names = list(keys)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    fields = [*[f"`{k}` {kinds[k]}" for k in keys], *[f"`{c}` {t}" for c, t in adds.items()]]
    columns = [*keys, *adds]
    added = [ARROW_TYPES[t] for t in adds.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, carry, done, types = None, None, [], []
        for batch in batches:
            types = [*[batch.schema.field(n).type for n in names], *added]
            heads = np.flatnonzero(_changes(batch, names)).tolist() if batch.num_rows else []
            for lo, hi in zip(heads, [*heads[1:], batch.num_rows]):
                here = tuple(batch.column(n)[lo].as_py() for n in names)
                if here != key:
                    if key is not None:
                        done.append((*key, *carry))
                    key, carry = here, None
                carry = step(carry, batch.slice(lo, hi - lo))
        if key is not None:
            done.append((*key, *carry))
        if done:
            made = [pa.array(list(values), kind) for values, kind in zip(zip(*done), types)]
            yield pa.RecordBatch.from_arrays(made, columns)

    return df.mapInArrow(run, ", ".join(fields))
