"""Message text: JSON in and out, local dates, battery level."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: instant format of message payloads.
INSTANT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

CORRUPT = "_corrupt_record"


def to_message(**fields: Column) -> Column:
    """One JSON object; null fields are left out, instants are written in UTC milliseconds."""
    return F.to_json(
        F.struct(*[value.alias(name) for name, value in fields.items()]),
        {"timestampFormat": INSTANT_FORMAT, "timeZone": "UTC"},
    )


def from_message(text: Column, schema: T.StructType, mode: str = "PERMISSIVE") -> Column:
    """Parse only the fields of ``schema``; unknown wire fields are ignored.

    In PERMISSIVE mode a malformed text leaves itself in the ``_corrupt_record`` field.
    """
    options = {"mode": mode, "timestampFormat": INSTANT_FORMAT, "timeZone": "UTC"}
    if mode == "PERMISSIVE":
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        options["columnNameOfCorruptRecord"] = CORRUPT
    return F.from_json(text, schema, options)


def local_date(instant: Column, tz: Column) -> Column:
    """Calendar day at the zone; the UTC day where the zone is unknown."""
    utc = instant.cast("timestamp")
    return F.coalesce(F.to_date(F.from_utc_timestamp(utc, tz)), F.to_date(utc))


def battery_level(percentage: Column, voltage: Column, alpha: Column, beta: Column) -> Column:
    """Reported percentage, else the floor of the clamped linear voltage model in float."""
    level = alpha.cast("float") * voltage.cast("float") + beta.cast("float")
    clamped = F.least(F.lit(100.0).cast("float"), F.greatest(F.lit(0.0).cast("float"), level))
    return F.coalesce(percentage.cast("int"), F.floor(clamped).cast("int"))


def lower_key(key: Column) -> Column:
    return F.lower(key)
