"""Row filters and one-pass splits."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The three token transfer directions.
OPERATOR_TO_RIDER = "NetworkOperatorToRider"
OWNER_TO_RIDER = "OwnerToRider"
RIDER_TO_OWNER = "RiderToOwner"
OWNER_INVOLVED = (OWNER_TO_RIDER, RIDER_TO_OWNER)

# Fixed value: a payment run looks back one and a half intervals.
LOOK_BACK_FACTOR = 1.5


def drop_nulls(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna("any", subset=list(columns))


def tag_route(df: DataFrame, routes: Mapping[str, Column], otherwise: str) -> DataFrame:
    """Name the first route whose condition holds; a null condition does not hold.

    The outputs of a multi-way split are filters on the tag, so the input is computed once.
    """
    tag = None
    for name, condition in routes.items():
        tag = F.when(condition, name) if tag is None else tag.when(condition, name)
    return df.withColumn("route", tag.otherwise(otherwise))


def route(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("route") == name).drop("route")


def look_back(as_of: datetime, interval_ms: int) -> tuple[datetime, datetime]:
    """(from, until) of a payment run."""
    return as_of - timedelta(milliseconds=LOOK_BACK_FACTOR * interval_ms), as_of


def payable_rides(rides: DataFrame, since: datetime, until: datetime) -> DataFrame:
    """Ended in ``[since, until]``, not captured yet, payment method chosen."""
    return rides.where(
        F.col("end_time").between(
            F.lit(since.isoformat(" ")).cast(rides.schema["end_time"].dataType),
            F.lit(until.isoformat(" ")).cast(rides.schema["end_time"].dataType),
        )
        & F.col("capture_transaction_id").isNull()
        & F.col("paid_with_token").isNotNull()
    )


def without_requests(rides: DataFrame, requests: DataFrame) -> DataFrame:
    """Rides no earlier run has asked to be paid; overlapping runs then never pay twice."""
    return rides.join(requests.select("ride_id"), "ride_id", "left_anti")


def operator_transfers(messages: DataFrame) -> DataFrame:
    return messages.where(F.col("transaction_type") == OPERATOR_TO_RIDER)


def owner_transfers(messages: DataFrame) -> DataFrame:
    return messages.where(F.col("transaction_type").isin(*OWNER_INVOLVED))
