"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridewright.session import scratch_path

BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20

# Words of the matching operators: after lower-casing A-Z, runs of digits, a-z and all non-ASCII.
WORD_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def cut(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows, and of BATCH_BYTES or a single row; an empty batch stays one."""
    for batch in batches:
        per_row = max(1, batch.nbytes // max(1, batch.num_rows))
        size = max(1, min(rows, BATCH_BYTES // per_row))
        for lo in range(0, max(1, batch.num_rows), size):
            yield batch.slice(lo, size)


def free_name(columns: Iterable[str], name: str) -> str:
    """The name, behind as many underscores as it takes to be none of the columns, whatever their case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write rows to the shared folder and read them back: nothing above them is computed again."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; a null key counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(modulus)).cast("int")


def words_of(raw: bytes | None) -> list[bytes]:
    """The words of UTF-8 text; none for null."""
    return raw.translate(WORD_TABLE).split() if raw else []


def raw_texts(column: pa.Array) -> list[bytes | None]:
    """A string column as UTF-8 bytes, without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def map_batches(
    df: DataFrame,
    step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: T.StructType,
    rows: int = BATCH_ROWS,
) -> DataFrame:
    """mapInArrow over batches of at most ``rows`` rows, cut inside the step: no session setting is touched.

    Spark itself hands over at most 64 MB of rows at once.
    """
    return df.mapInArrow(lambda batches: step(cut(batches, rows)), schema)
