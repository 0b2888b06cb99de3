"""Telemetry merged onto vehicles, and search for available vehicles near a cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridewright.functions import geo, messages

TELEMETRY_FIELDS = ["battery_percentage", "battery_voltage", "state", "geohash"]


def latest_fields(updates: DataFrame, version: list[str]) -> DataFrame:
    """Per device, the newest non-null value of each field.

    Battery percentage and voltage come from one message, the newest that has either; the other fields
    are independent of each other. The aggregates merge before the shuffle.
    """
    located = updates.withColumn(
        "geohash", F.coalesce(F.col("geohash"), geo.geohash(F.col("lat"), F.col("lon")))
    )
    at = F.struct(*version)
    battery = F.struct("battery_percentage", "battery_voltage")
    charged = F.col("battery_percentage").isNotNull() | F.col("battery_voltage").isNotNull()
    newest = located.groupBy("device_id").agg(
        F.max_by(battery, F.when(charged, at)).alias("battery"),
        *[F.max_by(field, F.when(F.col(field).isNotNull(), at)).alias(field) for field in ("state", "geohash")],
    )
    return newest.select("device_id", "battery.battery_percentage", "battery.battery_voltage", "state", "geohash")


def timed_fields(updates: DataFrame, ts: str) -> DataFrame:
    """Like :func:`latest_fields`, with the instant of each value: battery_ts, state_ts and geohash_ts."""
    newest = latest_fields(updates, [ts])
    located = F.col("geohash").isNotNull() | (F.col("lat").isNotNull() & F.col("lon").isNotNull())
    charged = F.col("battery_percentage").isNotNull() | F.col("battery_voltage").isNotNull()
    instants = updates.groupBy("device_id").agg(
        F.max(F.when(charged, F.col(ts))).alias("battery_ts"),
        F.max(F.when(F.col("state").isNotNull(), F.col(ts))).alias("state_ts"),
        F.max(F.when(located, F.col(ts))).alias("geohash_ts"),
    )
    return newest.join(instants, "device_id")


def merge_telemetry(vehicles: DataFrame, newest: DataFrame) -> DataFrame:
    """Vehicles that reported, with reported fields replaced and the rest kept.

    Device ids are not unique among vehicles; every vehicle of a device is updated. A vehicle
    without a device takes no telemetry.
    """
    incoming = newest.select(
        F.col("device_id"), *[F.col(f).alias(f"_{f}") for f in TELEMETRY_FIELDS]
    )
    known = vehicles.where(F.col("device_id") != "").join(incoming, "device_id")
    level = messages.battery_level(
        F.col("_battery_percentage"),
        F.col("_battery_voltage"),
        F.col("battery_alpha"),
        F.col("battery_beta"),
    )
    return (
        known.withColumn("battery_percentage", F.coalesce(level, F.col("battery_percentage")))
        .withColumn("geo_hash", F.coalesce("_geohash", "geo_hash"))
        .withColumn("device_state", F.coalesce("_state", "device_state"))
        .drop(*[f"_{f}" for f in TELEMETRY_FIELDS])
    )


def search_card() -> Column:
    """One vehicle of a search result; null fields are left out."""
    return messages.to_message(
        qrCode=F.col("qr_code"),
        id=F.col("vehicle_id"),
        batteryPercentage=F.col("battery_percentage"),
        status=F.col("status"),
        model=F.col("model"),
        geoHash=F.col("geo_hash"),
        operator_name=F.col("operator_name"),
        base_price=F.col("base_price"),
        price_per_minute=F.col("price_per_minute"),
    )


def _searches(requests: DataFrame) -> DataFrame:
    """Distinct searched cells: a result depends on nothing else."""
    return requests.select(
        "prefix_length", geo.prefix(F.col("location_hash"), F.col("prefix_length")).alias("prefix")
    ).distinct()


def _available_by_cell(vehicles: DataFrame, requests: DataFrame) -> DataFrame:
    """Available vehicles once per searched prefix length, with the cell at that length."""
    # at most twelve lengths exist, so the list is small whatever the requests
    wanted = F.col("prefix_length").between(1, geo.FULL_LENGTH)
    lengths = [r[0] for r in requests.select("prefix_length").where(wanted).distinct().collect()]
    return (
        vehicles.where((F.col("status") == "available") & F.col("geo_hash").isNotNull())
        .select("vehicle_id", "geo_hash", search_card().alias("card"))
        .withColumn("prefix_length", F.explode(F.array(*[F.lit(n) for n in sorted(lengths)]).cast("array<int>")))
        .withColumn("cell", geo.code_prefix(geo.cell_code(F.col("geo_hash")), F.col("prefix_length")))
    )


def search_results(
    requests: DataFrame, vehicles: DataFrame, page_size: int = 1000
) -> DataFrame:
    """JSON arrays of vehicle cards for every searched cell and its neighbours, ``[]`` when empty.

    ``requests`` has location_hash and prefix_length. Equal searches are answered once, and a
    vehicle has one cell per length with at most nine searched cells around it, so the joined rows
    grow with the vehicles and not with requests times vehicles. A result of up to ``page_size``
    cards is one array; a larger one is split by vehicle hash into pages of about that size, so
    no task or row holds a crowded cell as a whole.
    """
    searches = _searches(requests)
    around = geo.with_neighbour_codes(searches, "prefix", "cell")
    placed = _available_by_cell(vehicles, requests)
    cell = ["prefix_length", "cell"]
    search = ["prefix_length", "prefix"]
    per_cell = placed.groupBy(*cell).count()
    sized = (
        around.join(per_cell, cell, "left")
        .groupBy(*search)
        .agg(F.coalesce(F.sum("count"), F.lit(0)).alias("vehicles_found"), F.collect_set("cell").alias("cells"))
        .withColumn(
            "pages",
            F.greatest(F.lit(1), F.ceil(F.col("vehicles_found") / F.lit(page_size))).cast("bigint"),
        )
    )
    spread = F.conv(F.left(F.md5(F.col("vehicle_id").cast("string")), F.lit(8)), 16, 10)
    page = F.when(F.col("pages") == 1, F.lit(0).cast("bigint")).otherwise(
        spread.cast("bigint") % F.col("pages")
    )
    cards = F.transform(
        F.array_sort(F.collect_list(F.struct("vehicle_id", "card"))), lambda c: c["card"]
    )
    filled = (
        sized.where("vehicles_found > 0")
        .withColumn("cell", F.explode("cells"))
        .join(placed, cell)
        .groupBy(*search, page.alias("page"))
        .agg(cards.alias("cards"), F.max("vehicles_found").alias("vehicles_found"))
        .select(
            *search,
            "page",
            "vehicles_found",
            F.concat(F.lit("["), F.array_join("cards", ","), F.lit("]")).alias("search_results"),
        )
    )
    empty = sized.where("vehicles_found = 0").select(
        *search,
        F.lit(0).cast("bigint").alias("page"),
        "vehicles_found",
        F.lit("[]").alias("search_results"),
    )
    return filled.unionByName(empty)
