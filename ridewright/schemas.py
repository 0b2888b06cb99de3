"""Fixed schemas of messages and stored tables; nothing is inferred at run time."""

from __future__ import annotations

from pyspark.sql import types as T


TEXT, FLAG, INT, SHORT = T.StringType(), T.BooleanType(), T.IntegerType(), T.ShortType()
FLOAT, INSTANT = T.FloatType(), T.TimestampType()
MONEY, RATE, FACTOR = T.DecimalType(18, 2), T.DecimalType(11, 6), T.DecimalType(7, 6)
DISTANCE, BATTERY = T.DecimalType(18, 3), T.DecimalType(10, 4)
DAY, COUNT = T.DateType(), T.LongType()
SUM, FEE, AWARD = T.DecimalType(36, 10), T.DecimalType(26, 8), T.DecimalType(28, 8)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Wire fields of the incoming messages, by topic.
MESSAGES = {
    "unlock-vehicle": _struct(
        qrCode=TEXT,
        riderId=TEXT,
        jobId=TEXT,
    ),
    "lock-vehicle": _struct(
        deviceId=TEXT,
        stateChanged=FLAG,
        jobId=TEXT,
        vehicleId=TEXT,
        vendor=TEXT,
    ),
    "end-ride": _struct(
        riderId=TEXT,
        jobId=TEXT,
        parkingImageUrl=TEXT,
        paymentMethodToken=FLAG,
    ),
    "cordon-vehicle": _struct(
        jobId=TEXT,
        vehicleId=TEXT,
        deviceId=TEXT,
    ),
    "uncordon-vehicle": _struct(
        jobId=TEXT,
        vehicleId=TEXT,
    ),
    "search-vehicles": _struct(
        locationHash=TEXT,
        searchPrefixLength=SHORT,
    ),
    "iot-updates": _struct(
        vendor=TEXT,
        deviceId=TEXT,
        interval=INT,
        timestamp=INSTANT,
        batteryVoltage=FLOAT,
        batteryPercentage=FLOAT,
        internalBatteryVoltage=FLOAT,
        internalBatteryPercentage=FLOAT,
        longitude=FLOAT,
        latitude=FLOAT,
        geohash=TEXT,
        heading=FLOAT,
        altitude=FLOAT,
        alarm=FLAG,
        state=TEXT,
    ),
    "payment-choice": _struct(
        riderId=TEXT,
        vehicleId=TEXT,
        startTime=INSTANT,
        paymentMethodToken=FLAG,
    ),
    "update-balance": _struct(
        riderId=TEXT,
        vehicleId=TEXT,
        startTime=INSTANT,
        paymentMethodToken=FLAG,
    ),
    "token-payment": _struct(
        fromAddr=TEXT,
        toAddr=TEXT,
        transactionType=TEXT,
        ownerId=TEXT,
        amount=MONEY,
    ),
}
for _topic in ("garage", "ungarage", "cordon-garage", "ungarage-uncordon"):
    MESSAGES[f"{_topic}-vehicle"] = MESSAGES["lock-vehicle"]

# Stored tables. Key columns of wallets are never part of a schema.
TABLES = {
    "vehicles": _struct(
        vehicle_id=TEXT,
        owner_id=TEXT,
        status=TEXT,
        qr_code=TEXT,
        device_id=TEXT,
        vendor=TEXT,
        model=TEXT,
        operator_name=TEXT,
        base_price=MONEY,
        price_per_minute=MONEY,
        reward_base=MONEY,
        reward_factor=FACTOR,
        battery_percentage=INT,
        battery_alpha=BATTERY,
        battery_beta=BATTERY,
        geo_hash=TEXT,
        device_state=TEXT,
        in_transition=FLAG,
    ),
    "owners": _struct(
        owner_id=TEXT,
        company_name=TEXT,
        currency_code=TEXT,
        commission_factor=FACTOR,
        token_share=FACTOR,
        token_balance_base=MONEY,
        vendor_id=TEXT,
        wallet_address=TEXT,
    ),
    "riders": _struct(
        rider_id=TEXT,
        token_balance=MONEY,
        payment_method_id=TEXT,
    ),
    "rates": _struct(
        currency_code=TEXT,
        rate=RATE,
        updated_timestamp=INSTANT,
    ),
    "active_rides": _struct(
        rider_id=TEXT,
        ride_id=TEXT,
        vehicle_id=TEXT,
        start_time=INSTANT,
        start_geohash=TEXT,
        last_geohash=TEXT,
        start_battery=INT,
        last_battery=INT,
        distance=DISTANCE,
        auth_transaction_id=TEXT,
    ),
    "authorisations": _struct(
        ride_id=TEXT,
        auth_transaction_id=TEXT,
    ),
}
_RIDE = dict(
    ride_id=TEXT,
    rider_id=TEXT,
    vehicle_id=TEXT,
    owner_id=TEXT,
    start_time=INSTANT,
    end_time=INSTANT,
    effective_date=DAY,
    parking_image_url=TEXT,
    rating=INT,
    price=MONEY,
    currency_code=TEXT,
    conversion_rate=RATE,
    commission=FEE,
    commission_factor=FACTOR,
    token_share=FACTOR,
    paid_with_token=FLAG,
    capture_transaction_id=TEXT,
    token_awarded=AWARD,
    distance=DISTANCE,
    auth_transaction_id=TEXT,
    start_geohash=TEXT,
    last_geohash=TEXT,
)
_RATINGS = {f"rating_{k}_count": COUNT for k in range(1, 6)}
TABLES |= {
    "rides_summary": _struct(**_RIDE),
    # the same rides by the day on which they ended, for runs that look back from now
    "rides_ended": _struct(**_RIDE, end_day=DAY),
    "vehicle_stats_daily": _struct(
        vehicle_id=TEXT,
        date=DAY,
        owner_id=TEXT,
        currency_code=TEXT,
        rides_count=COUNT,
        fiat_revenue=SUM,
        token_revenue=SUM,
        **_RATINGS,
        last_parking_image_url=TEXT,
        rides_accumulate=COUNT,
        fiat_accumulate=SUM,
        token_accumulate=SUM,
    ),
    "owner_stats_daily": _struct(
        owner_id=TEXT,
        date=DAY,
        currency_code=TEXT,
        vehicles_count=COUNT,
        rides_count=COUNT,
        fiat_revenue=SUM,
        token_revenue=SUM,
        rides_accumulate=COUNT,
        fiat_accumulate=SUM,
        token_accumulate=SUM,
    ),
    "payments": _struct(
        ride_id=TEXT,
        owner_id=TEXT,
        rider_id=TEXT,
        transaction_time=INSTANT,
        transaction_id=TEXT,
        vaulted_shopper_id=TEXT,
        vendor_id=TEXT,
        commission_factor=FACTOR,
        reward_commission_factor=T.DecimalType(28, 10),
        currency_code=TEXT,
        amount=MONEY,
    ),
    "transfers": _struct(
        transfer_id=TEXT,
        from_address=TEXT,
        to_address=TEXT,
        owner_id=TEXT,
        transaction_type=TEXT,
        amount=T.DecimalType(28, 2),
        queued_at=INSTANT,
        state=TEXT,
        changed_at=INSTANT,
    ),
}
