"""Daily vehicle and owner statistics with running totals."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridewright.functions import money

RATINGS = range(1, 6)
TOTAL = "decimal(36,10)"
RUNNING = {
    "rides_count": "rides_accumulate",
    "fiat_revenue": "fiat_accumulate",
    "token_revenue": "token_accumulate",
}


def stats_dates(now_utc: datetime) -> list[date]:
    """Today, and the neighbour day some zones are still or already in."""
    today = now_utc.date()
    return [today, today + timedelta(days=1 if now_utc.hour >= 12 else -1)]


def daily_vehicle_stats(rides: DataFrame, token_code: str) -> DataFrame:
    """One row per vehicle and day with rides.

    ``rides`` carries price, conversion rate and the owner's factors. All aggregates merge, so the
    rides of one vehicle are reduced inside each input split before the shuffle. Ratings outside
    1..5 count nowhere; owner and currency come from the day's first ride.
    """
    fiat, token = money.revenue_split(
        F.col("price"),
        F.col("commission_factor"),
        F.col("token_share"),
        F.col("rate"),
        F.col("currency_code"),
        token_code,
    )
    # computed once per ride below the aggregate, where the expressions compile into the scan
    shares = rides.select(
        "vehicle_id",
        F.col("effective_date").alias("date"),
        fiat.alias("fiat"),
        token.alias("token"),
        "rating",
        "start_time",
        "end_time",
        "ride_id",
        "owner_id",
        "currency_code",
        "parking_image_url",
    )
    ended = F.when(F.col("end_time").isNotNull(), F.struct("end_time", "ride_id"))
    first = F.min_by(F.struct("owner_id", "currency_code"), F.struct("start_time", "ride_id"))
    return (
        shares.groupBy("vehicle_id", "date")
        .agg(
            first.alias("_first"),
            F.count(F.lit(1)).alias("rides_count"),
            F.sum("fiat").cast(TOTAL).alias("fiat_revenue"),
            F.sum("token").cast(TOTAL).alias("token_revenue"),
            *[F.count_if(F.col("rating") == k).alias(f"rating_{k}_count") for k in RATINGS],
            F.max_by("parking_image_url", ended).alias("_photo"),
            F.count("end_time").alias("_ended"),
        )
        .select(
            "vehicle_id",
            "date",
            "_first.owner_id",
            "_first.currency_code",
            "rides_count",
            "fiat_revenue",
            "token_revenue",
            *[f"rating_{k}_count" for k in RATINGS],
            F.when(F.col("_ended") == 0, F.lit("")).otherwise(F.col("_photo")).alias(
                "last_parking_image_url"
            ),
        )
    )


def accumulate(today: DataFrame, yesterday: DataFrame) -> DataFrame:
    """Today's figures plus yesterday's running totals; without a yesterday, today alone."""
    previous = yesterday.select(
        F.col("vehicle_id").alias("_vehicle"),
        F.date_add("date", 1).alias("_date"),
        *[F.col(total).alias(f"_{total}") for total in RUNNING.values()],
    )
    joined = today.join(
        previous,
        (F.col("vehicle_id") == F.col("_vehicle")) & (F.col("date") == F.col("_date")),
        "left",
    )
    return joined.select(
        *today.columns,
        *[
            (F.col(value) + F.coalesce(F.col(f"_{total}"), F.lit(0))).cast(
                today.schema[value].dataType
            ).alias(total)
            for value, total in RUNNING.items()
        ],
    )


def carry_forward(
    today: DataFrame, vehicles: DataFrame, yesterday: DataFrame, day: date
) -> DataFrame:
    """Rows of one day for all vehicles that have rides today or a history.

    A vehicle idle today keeps its running totals in a zero row dated ``day``; one without rides
    and without history has no row.
    """
    totals = list(RUNNING.values())
    previous = yesterday.where(F.col("date") == F.date_sub(F.lit(day), 1)).select(
        F.col("vehicle_id"),
        F.col("currency_code").alias("_currency"),
        *[F.col(t).alias(f"_{t}") for t in totals],
    )
    active = today.where(F.col("date") == F.lit(day)).withColumnRenamed("owner_id", "_ride_owner")
    sides = (
        active.join(vehicles.select("vehicle_id", "owner_id"), "vehicle_id", "full_outer")
        .join(previous, "vehicle_id", "left")
    )
    idle = F.col("rides_count").isNull()
    zero_or = lambda c: F.coalesce(F.col(c), F.lit(0)).cast(today.schema[c].dataType)
    return sides.where(~idle | F.col("_rides_accumulate").isNotNull()).select(
        "vehicle_id",
        F.lit(day).alias("date"),
        F.coalesce("_ride_owner", "owner_id").alias("owner_id"),
        F.coalesce("currency_code", "_currency").alias("currency_code"),
        *[zero_or(c).alias(c) for c in RUNNING],
        *[zero_or(f"rating_{k}_count").alias(f"rating_{k}_count") for k in RATINGS],
        F.coalesce("last_parking_image_url", F.lit("")).alias("last_parking_image_url"),
        *[
            (zero_or(c) + F.coalesce(F.col(f"_{t}"), F.lit(0))).cast(today.schema[c].dataType).alias(t)
            for c, t in RUNNING.items()
        ],
    )


def backfill(daily: DataFrame, last_day: Column) -> DataFrame:
    """Running totals for every vehicle and day from its first ride day to ``last_day``.

    Rows per vehicle are bounded by the calendar, not by the rides, so the window stays small.
    Idle days are opened as gaps after each ride day; no second pass over the data is needed.
    """
    by_day = Window.partitionBy("vehicle_id").orderBy("date")
    running = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = daily.select(
        *daily.columns,
        *[
            F.sum(value).over(running).cast(daily.schema[value].dataType).alias(total)
            for value, total in RUNNING.items()
        ],
        F.coalesce(F.date_sub(F.lead("date").over(by_day), 1), last_day).alias("_until"),
    )
    days = totals.withColumn("_day", F.explode(F.sequence("date", "_until")))
    idle = F.col("_day") != F.col("date")
    counted = [*RUNNING, *[f"rating_{k}_count" for k in RATINGS]]
    return days.select(
        "vehicle_id",
        F.col("_day").alias("date"),
        "owner_id",
        "currency_code",
        *[
            F.when(idle, F.lit(0).cast(daily.schema[c].dataType)).otherwise(F.col(c)).alias(c)
            for c in counted
        ],
        F.when(idle, F.lit("")).otherwise(F.col("last_parking_image_url")).alias(
            "last_parking_image_url"
        ),
        *RUNNING.values(),
    )


def daily_owner_stats(vehicle_days: DataFrame) -> DataFrame:
    """Vehicle rows rolled up to owner and day; missing running totals are skipped."""
    return vehicle_days.groupBy("owner_id", "date").agg(
        F.min_by("currency_code", "vehicle_id").alias("currency_code"),
        F.count(F.lit(1)).alias("vehicles_count"),
        F.sum("rides_count").alias("rides_count"),
        F.sum("fiat_revenue").cast(TOTAL).alias("fiat_revenue"),
        F.sum("token_revenue").cast(TOTAL).alias("token_revenue"),
        F.sum("rides_accumulate").alias("rides_accumulate"),
        F.sum("fiat_accumulate").cast(TOTAL).alias("fiat_accumulate"),
        F.sum("token_accumulate").cast(TOTAL).alias("token_accumulate"),
    )


def set_parking_photo(stats: DataFrame, photos: DataFrame) -> DataFrame:
    """Latest photo per owner, vehicle and day written onto the stored statistics row."""
    keys = ["owner_id", "vehicle_id", "date"]
    newest = photos.groupBy(*keys).agg(
        F.max_by("parking_image_url", F.struct("end_time", "ride_id")).alias("_photo")
    )
    return (
        stats.join(newest, keys, "left")
        .withColumn("last_parking_image_url", F.coalesce("_photo", "last_parking_image_url"))
        .drop("_photo")
    )
