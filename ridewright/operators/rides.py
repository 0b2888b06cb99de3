"""Ending and starting a ride: enrichment, price, award, and what is written and sent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridewright.functions import geo, messages, money
from ridewright.operators.lookup import lookup


def enrich_end_ride(
    ended: DataFrame,
    active: DataFrame,
    vehicles: DataFrame,
    owners: DataFrame,
    rates: DataFrame,
    key: str = "ride_id",
) -> DataFrame:
    """End-ride messages with the open ride, its vehicle, the owner and the conversion rate.

    ``key`` names the open ride in a message: the ride, or the rider. Messages without an open ride, vehicle or owner are dropped; a currency without a rate
    converts at 1.
    Owner and rate are joined to the vehicles, of which there are far fewer than rides: rides are shuffled by
    ride and by vehicle only.
    """
    wanted = ["ride_id", "rider_id", "vehicle_id", "start_time", "distance", *CARRIED_OVER]
    with_ride = lookup(
        ended,
        active,
        [key],
        take=[c for c in wanted if c in active.columns and c != key],
        first_by=["start_time", "ride_id" if key == "rider_id" else "rider_id", "vehicle_id"],
    )
    owned = lookup(
        vehicles.select(
            "vehicle_id", "owner_id", "device_id", "base_price", "price_per_minute", "reward_base", "reward_factor"
        ),
        owners,
        ["owner_id"],
        take=["currency_code", "commission_factor", "token_share", "company_name", "vendor_id"],
    )
    rated = with_rate(owned, rates)
    return lookup(with_ride, rated, ["vehicle_id"], take=[c for c in rated.columns if c != "vehicle_id"])


def with_rate(df: DataFrame, rates: DataFrame) -> DataFrame:
    return lookup(
        df,
        rates,
        ["currency_code"],
        take=["rate"],
        keep_misses=True,
        defaults={"rate": F.lit(1).cast(money.RATE)},
    )


def price_rides(rides: DataFrame) -> DataFrame:
    """Add minutes, price, commission, token price and token award to enriched rides."""
    return (
        rides.withColumn("minutes", money.whole_minutes(F.col("start_time"), F.col("end_time")))
        .withColumn(
            "price",
            money.ride_price(F.col("base_price"), F.col("price_per_minute"), F.col("minutes")),
        )
        .withColumn("commission", money.commission(F.col("price"), F.col("commission_factor")))
        .withColumn("token_price", money.token_price(F.col("price"), F.col("rate")))
        .withColumn(
            "token_awarded",
            money.token_award(
                F.col("token_price"),
                F.col("reward_base"),
                F.col("reward_factor"),
                F.col("commission_factor"),
            ),
        )
    )


def with_local_date(rides: DataFrame, zones: DataFrame, prefix_length: int) -> DataFrame:
    """Add the local calendar day of the start cell; the UTC day where no zone is known."""
    cells = rides.withColumn("_cell", geo.prefix(F.col("start_geohash"), prefix_length))
    zoned = lookup(cells, zones, {"_cell": "cell"}, take=["tz_id"], keep_misses=True)
    return zoned.withColumn(
        "effective_date", messages.local_date(F.col("start_time"), F.col("tz_id"))
    ).drop("_cell")


# What the open ride hands to the summary.
CARRIED_OVER = ["auth_transaction_id", "start_geohash", "last_geohash"]


def ride_summaries(priced: DataFrame) -> DataFrame:
    """The row stored for a finished ride: unrated, payment method and capture still open."""
    return priced.select(
        "ride_id",
        "rider_id",
        "vehicle_id",
        "owner_id",
        "start_time",
        "end_time",
        "effective_date",
        "parking_image_url",
        F.lit(0).alias("rating"),
        "price",
        "currency_code",
        F.col("rate").alias("conversion_rate"),
        "commission",
        "commission_factor",
        "token_share",
        F.lit(None).cast("boolean").alias("paid_with_token"),
        F.lit(None).cast("string").alias("capture_transaction_id"),
        "token_awarded",
        "distance",
        *[F.col(c) if c in priced.columns else F.lit(None).cast("string").alias(c) for c in CARRIED_OVER],
    )


EFFECTIVE_DATE_COLUMNS = [
    "effective_date",
    "rider_id",
    "vehicle_id",
    "owner_id",
    "start_time",
    "end_time",
    "parking_image_url",
    "rating",
    "price",
    "currency_code",
    "conversion_rate",
    "commission_factor",
    "token_share",
    "paid_with_token",
]


def effective_date_copy(summaries: DataFrame) -> DataFrame:
    """Narrow copy read by the daily statistics; carries the ride's own rating."""
    return summaries.select("ride_id", *EFFECTIVE_DATE_COLUMNS)


def lock_command(device: Column, vendor: Column, vehicle: Column) -> Column:
    return messages.to_message(vehicleId=vehicle, deviceId=device, vendor=vendor)


def balance_command(rider: Column, vehicle: Column, start: Column, by_token: Column) -> Column:
    return messages.to_message(
        riderId=rider,
        vehicleId=vehicle,
        startTime=start.cast("timestamp"),
        paymentMethodToken=by_token,
    )


def open_rides(unlocked: DataFrame) -> DataFrame:
    """Rows of the open-ride table: event time is the start, no distance yet."""
    return unlocked.select(
        "rider_id",
        "vehicle_id",
        F.col("ts").alias("start_time"),
        F.col("geo_hash").alias("start_geohash"),
        F.col("geo_hash").alias("last_geohash"),
        F.col("battery_percentage").alias("start_battery"),
        F.col("battery_percentage").alias("last_battery"),
        F.lit(0).cast("decimal(18,3)").alias("distance"),
        F.lit(None).cast("string").alias("auth_transaction_id"),
    )


def unlock_details(
    requests: DataFrame, vehicles: DataFrame, riders: DataFrame, default_minutes: float
) -> DataFrame:
    """Unlock requests with vehicle, rider's payment method and the amount to authorise."""
    keyed = requests.withColumn("_qr", messages.lower_key(F.col("qr_code")))
    by_qr = vehicles.withColumn("_qr", messages.lower_key(F.col("qr_code")))
    found = lookup(
        keyed,
        by_qr,
        ["_qr"],
        take=["vehicle_id", "owner_id", "device_id", "base_price", "price_per_minute"],
        first_by=["vehicle_id"],
    ).drop("_qr")
    known = lookup(found, riders, ["rider_id"], take=["payment_method_id"])
    amount = F.col("base_price").cast("double") + F.col("price_per_minute").cast(
        "double"
    ) * F.lit(float(default_minutes))
    return known.withColumn("auth_amount", amount)


def token_payment_allowed(rides: DataFrame, riders: DataFrame) -> DataFrame:
    """Whether the rider's token balance covers the price; unknown riders may not pay in tokens."""
    known = lookup(rides, riders, ["rider_id"], take=["token_balance"], keep_misses=True)
    worth = F.coalesce(F.col("token_balance"), F.lit(0).cast(money.MONEY)) * F.col("rate")
    return known.withColumn(
        "token_allowed", F.coalesce(worth >= F.col("price"), F.lit(False))
    )


def rides_without_method(messages_df: DataFrame, summaries: DataFrame) -> DataFrame:
    """Balance messages whose stored ride has no payment method yet; repeats fall away."""
    stored = lookup(
        messages_df,
        summaries,
        ["ride_id"],
        take=["paid_with_token", "price", "owner_id"],
        first_by=["start_time", "vehicle_id", "price"],
    )
    return stored.where(F.col("paid_with_token").isNull())


def choose_method(summaries: DataFrame, choices: DataFrame) -> DataFrame:
    """Store the chosen payment method; a ride paid in tokens earns no award."""
    picked = lookup(
        summaries.withColumnRenamed("paid_with_token", "_stored"),
        choices,
        ["ride_id"],
        take=["chosen_token"],
        keep_misses=True,
        first_by=["chosen_token"],
    )
    return (
        picked.withColumn("paid_with_token", F.coalesce("chosen_token", "_stored"))
        .withColumn(
            "token_awarded",
            F.when(F.col("chosen_token"), F.lit(0).cast(summaries.schema["token_awarded"].dataType))
            .otherwise(F.col("token_awarded")),
        )
        .drop("_stored", "chosen_token")
    )


# Stored as the capture id of rides that needed no card capture.
TOKEN_CAPTURE_MARK = "paid-with-token"


def mark_paid(summaries: DataFrame, captures: DataFrame) -> DataFrame:
    """Set the capture id; token rides get a fixed mark, a failed capture leaves the ride payable."""
    found = lookup(
        summaries.withColumnRenamed("capture_transaction_id", "_stored"),
        captures,
        ["ride_id"],
        take=["capture_id"],
        keep_misses=True,
        first_by=["capture_id"],
    )
    new = F.when(F.col("paid_with_token"), F.lit(TOKEN_CAPTURE_MARK)).otherwise(
        F.col("capture_id")
    )
    return found.withColumn("capture_transaction_id", F.coalesce("_stored", new)).drop(
        "_stored", "capture_id"
    )


def rider_balances(riders: DataFrame, rides: DataFrame) -> DataFrame:
    """Token balance after all rides: a ledger sum, so neither order nor retries matter."""
    change = money.rider_token_change(
        F.col("paid_with_token"), F.col("price"), F.col("rate"), F.col("token_awarded")
    )
    changes = rides.groupBy("rider_id").agg(F.sum(change).alias("change"))
    return lookup(
        riders,
        changes,
        ["rider_id"],
        take=["change"],
        keep_misses=True,
    ).withColumn(
        "new_balance",
        (
            F.coalesce(F.col("token_balance"), F.lit(0).cast(money.MONEY))
            + F.coalesce(F.col("change"), F.lit(0).cast(money.MONEY))
        ).cast("decimal(38,2)"),
    )


def rides_in_progress(opens: DataFrame, closes: DataFrame) -> DataFrame:
    """Rides opened and not closed; one open ride per rider, the latest one."""
    still = opens.join(closes.select("ride_id"), "ride_id", "left_anti")
    rest = [c for c in still.columns if c != "rider_id"]
    return (
        still.groupBy("rider_id")
        .agg(F.max_by(F.struct(*rest), F.struct("start_time", "ride_id")).alias("_row"))
        .select("rider_id", "_row.*")
    )


def invoice_rows(rides: DataFrame, riders: DataFrame, owners: DataFrame, cards: DataFrame) -> DataFrame:
    """One printable row per paid ride."""
    with_owner = lookup(
        rides, owners, ["owner_id"], take=["company_name", "currency_code"]
    )
    with_rider = lookup(with_owner, riders, ["rider_id"], take=["payment_method_id"])
    full = lookup(
        with_rider,
        cards,
        ["payment_method_id"],
        take=["card_last4", "card_brand"],
        keep_misses=True,
        first_by=["card_last4", "card_brand"],
    )
    millis = money.duration_millis(F.col("start_time"), F.col("end_time"))
    seconds = F.call_function("div", millis, F.lit(1000).cast("bigint"))
    minutes = F.call_function("div", seconds, F.lit(60).cast("bigint"))
    sign = F.when(F.col("paid_with_token"), F.lit("- ")).otherwise(F.lit(""))
    return full.select(
        "ride_id",
        F.concat(F.lit("Ride with "), F.col("company_name")).alias("title"),
        F.date_format("end_time", "dd/MM/yy, HH:mm").alias("printed"),
        F.concat(minutes.cast("string"), F.lit(":"), (seconds % 60).cast("string"), F.lit(" mins")).alias(
            "duration"
        ),
        money.two_digits_text(F.coalesce(F.col("distance"), F.lit(0)).cast("decimal(18,3)"), 3).alias("distance"),
        F.concat(
            sign, money.two_digits_text(F.col("price"), 2), F.lit(" "), F.col("currency_code")
        ).alias("total"),
        F.concat(
            F.date_format("end_time", "yy-MM-dd_HH-mm"),
            F.lit("_"),
            F.col("rider_id").cast("string"),
            F.lit(".pdf"),
        ).alias("object_name"),
        F.when(~F.col("paid_with_token"), F.col("card_last4")).alias("card_last4"),
        F.when(~F.col("paid_with_token"), F.col("card_brand")).alias("card_brand"),
    )
