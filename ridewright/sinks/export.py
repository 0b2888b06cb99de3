"""Warehouse export: text dates and times, re-scaled decimals, no key material."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns that never leave the store.
SECRET_COLUMNS = {"private_key"}
EXPORT_SCALE = 9


def _truncated(value: Column, kind: T.DecimalType) -> Column:
    if kind.scale <= EXPORT_SCALE:
        return value
    cut = F.when(value < 0, F.ceil(value, F.lit(EXPORT_SCALE))).otherwise(
        F.floor(value, F.lit(EXPORT_SCALE))
    )
    return cut.cast(T.DecimalType(38, EXPORT_SCALE))


def export_rows(df: DataFrame, skip: Iterable[str] = ()) -> DataFrame:
    """Project a table for export.

    Dates become ``yyyy-MM-dd``, instants 24-hour text, decimals keep at most nine digits (cut,
    not rounded); binary and key columns are left out.
    """
    hidden = SECRET_COLUMNS | set(skip)
    out = []
    for field in df.schema.fields:
        if field.name in hidden or isinstance(field.dataType, T.BinaryType):
            continue
        value = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            value = F.date_format(value, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DecimalType):
            value = _truncated(value, field.dataType)
        out.append(value.alias(field.name))
    return df.select(*out)
