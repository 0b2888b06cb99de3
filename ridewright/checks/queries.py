"""Registered queries: every operator run over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridewright.checks.views import TOKEN, Views
from ridewright.functions import geo, messages, money
from ridewright.operators import (
    intervals,
    keyed,
    lifecycle,
    rides,
    rollup,
    routing,
    settlement,
    telemetry,
)
from ridewright.operators.lookup import latest_per_key, lookup
from ridewright.session import apply_runtime_conf
from ridewright.sinks import export, topics
from ridewright.sources import streams, tables
from ridewright.streaming import lifecycle as lifecycle_stream
from ridewright.streaming import settlement as settlement_stream
from ridewright.streaming import waiting
from ridewright.streaming.run import drain

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Run parameters.
LAST_DAY = date(2024, 2, 29)
STATS_DAY = date(2024, 1, 31)
AS_OF = datetime(2024, 3, 15)
PAYMENT_INTERVAL_MS = 40 * 86_400_000
EVENTS_CUT = "2024-01-16 00:00:00"
DEFAULT_RIDE_MINUTES = 5.0
OPERATOR_WALLET = "wallet-operator"
RIDER_WALLET = "wallet-riders"
ZONE_PREFIX = 5


def query(build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        apply_runtime_conf(spark)
        return build(Views(spark, folder))

    QUERIES[build.__name__] = run
    return build


# -- messages, scans, rates -------------------------------------------------------------------

END_RIDE_FIELDS = T.StructType(
    [
        T.StructField("riderId", T.StringType()),
        T.StructField("jobId", T.StringType()),
        T.StructField("parkingImageUrl", T.StringType()),
        T.StructField("paymentMethodToken", T.BooleanType()),
    ]
)

END_RIDE_BODIES = """
select event_id, ts,
 concat('{{"', case when event_id % 17 = 0 then 'rider' else 'riderId' end, '":"', cast(user_id as string),
  '","jobId":"job-', cast(event_id as string), '","parkingImageUrl":"img-', cast(event_id as string), '"',
  case when event_type = 'purchase' then ',"paymentMethodToken":true' when event_type = 'signup' then ',"paymentMethodToken":false' else '' end,
  ',"price":1', case when event_id % 10 = 0 then '' else '}}' end) body
from {events}
"""


@query
def parse_messages(v: Views) -> DataFrame:
    bodies = v.sql(END_RIDE_BODIES)
    decoded = streams.decode(bodies, "body", END_RIDE_FIELDS)
    fine = streams.good(decoded).select(
        "event_id",
        F.col("riderId").alias("rider_id"),
        F.col("jobId").alias("job_id"),
        F.col("parkingImageUrl").alias("parking_image_url"),
        F.col("paymentMethodToken").alias("paid_with_token"),
        F.lit("decoded").alias("outcome"),
    )
    dead = decoded.where("dead").select("event_id", F.lit("dead letter").alias("outcome"))
    kept = routing.drop_nulls(fine, "rider_id")
    return kept.unionByName(dead, allowMissingColumns=True)


@query
def scan_effective_date(v: Views) -> DataFrame:
    days = [STATS_DAY, LAST_DAY]
    return tables.on_dates(v.rides, days).select(
        "ride_id", "effective_date", "vehicle_id", "rating", "price"
    )


@query
def latest_rates(v: Views) -> DataFrame:
    responses = v.sql(
        """
        select ts, case when event_type = 'error' then 503 else 200 end status,
         concat('{{"data":{{"TOK":{{"quote":{{"USD":{{"price":', cast(cast(value as decimal(18,2)) as string),
          '}},"ILS":{{"price":', cast(cast(value + 1 as decimal(18,2)) as string),
          '}},"EUR":{{"price":1.0}}}}}}}}', case when event_id % 3 = 0 then '' else '}}' end) body
        from {events}
        """
    )
    return tables.latest_rates(responses, TOKEN)


# -- ride end ---------------------------------------------------------------------------------


def _rides(v: Views) -> DataFrame:
    """What end-ride messages and open rides are cut from."""
    times = ("start_time", "end_time", "effective_date")
    return v.shared("rides", "ride_id", "rider_id", "vehicle_id", *times, "parking_image_url", "distance", "k")


def _ended(v: Views) -> DataFrame:
    """End-ride messages: everything but the ride key, time and photo comes from lookups."""
    return _rides(v).where(F.col("end_time").isNotNull()).select(
        "ride_id", "end_time", "parking_image_url", "effective_date", "distance"
    )


def _carried() -> list[Column]:
    """What an open ride holds for its summary: most rides were authorised."""
    return [
        F.expr("case when k % 6 > 0 then concat('auth-', ride_id) end").alias("auth_transaction_id"),
        F.concat(F.lit("from-"), F.col("vehicle_id").cast("string")).alias("start_geohash"),
        F.concat(F.lit("to-"), F.col("rider_id").cast("string")).alias("last_geohash"),
    ]


def _priced(v: Views) -> DataFrame:
    active = _rides(v).select("ride_id", "rider_id", "vehicle_id", "start_time", *_carried())
    enriched = rides.enrich_end_ride(_ended(v), active, v.vehicles, v.owners, v.rates)
    return rides.price_rides(enriched)


@query
def enrich_end_ride(v: Views) -> DataFrame:
    active = _rides(v).select("ride_id", "rider_id", "vehicle_id", "start_time")
    full = rides.enrich_end_ride(_ended(v), active, v.vehicles, v.owners, v.rates)
    return full.select(
        "ride_id", "rider_id", "vehicle_id", "owner_id", "device_id", "start_time", "end_time",
        "base_price", "price_per_minute", "currency_code", "commission_factor", "company_name", "rate",
    )


@query
def ride_price(v: Views) -> DataFrame:
    return _priced(v).select("ride_id", "minutes", "price", "commission")


@query
def token_price_down(v: Views) -> DataFrame:
    return _priced(v).select("ride_id", "price", "rate", "token_price")


@query
def token_award(v: Views) -> DataFrame:
    return _priced(v).select("ride_id", "token_awarded")


@query
def ride_summary(v: Views) -> DataFrame:
    return rides.ride_summaries(_priced(v))


@query
def effective_date_copy(v: Views) -> DataFrame:
    return rides.effective_date_copy(rides.ride_summaries(_priced(v)))


@query
def ride_commands(v: Views) -> DataFrame:
    started = F.col("start_time")
    full = lookup(v.rides, v.vehicles, ["vehicle_id"], take=["device_id", "vendor"])
    locks = topics.to_topic(
        full, "lock-vehicle", rides.lock_command(F.col("device_id"), F.col("vendor"), F.col("vehicle_id"))
    )
    balances = topics.to_topic(
        full,
        "update-balance",
        rides.balance_command(F.col("rider_id"), F.col("vehicle_id"), started, F.col("paid_with_token")),
    )
    commands = topics.device_commands(full.withColumn("command", F.lit("locked")))
    return keyed.union_all([locks, balances, commands])


@query
def opened_rides(v: Views) -> DataFrame:
    unlocked = lookup(
        v.sql(
            """
            select ts, user_id rider_id, event_id % (select count(*) from {part}) vehicle_id
            from {events} where event_type = 'view'
            """
        ),
        v.vehicles.withColumn("geo_hash", geo.geohash(F.col("lat"), F.col("lon"))),
        ["vehicle_id"],
        take=["geo_hash", "battery_percentage"],
    )
    return rides.open_rides(unlocked)


@query
def local_effective_date(v: Views) -> DataFrame:
    """Start cells are the vehicles' cells; every fourth longitude band has no known zone."""
    zones = v.vehicles.select(
        geo.prefix(geo.geohash(F.col("lat"), F.col("lon")), ZONE_PREFIX).alias("cell"),
        F.floor((F.col("lon") - 34.7) * 100).cast("int").alias("band"),
    )
    cells = (
        zones.groupBy("cell")
        .agg(F.min("band").alias("band"))
        .withColumn(
            "tz_id",
            F.when(F.col("band") % 4 == 1, "Asia/Jerusalem")
            .when(F.col("band") % 4 == 2, "Asia/Tokyo")
            .when(F.col("band") % 4 == 3, "America/New_York"),
        )
    )
    located = lookup(
        v.rides.drop("effective_date"),
        v.vehicles.select("vehicle_id", geo.geohash(F.col("lat"), F.col("lon")).alias("start_geohash")),
        ["vehicle_id"],
        take=["start_geohash"],
    )
    return rides.with_local_date(located, cells, ZONE_PREFIX).select(
        "ride_id", "tz_id", "effective_date"
    )


@query
def auth_amount(v: Views) -> DataFrame:
    requests = v.sql(
        """
        select event_id, user_id rider_id, concat(case when event_id % 2 = 0 then 'qr' else 'Qr' end, cast(event_id % (select count(*) from {part}) as string)) qr_code
        from {events}
        """
    )
    return rides.unlock_details(requests, v.vehicles, v.riders, DEFAULT_RIDE_MINUTES).select(
        "event_id", "vehicle_id", "owner_id", "device_id", "payment_method_id", "auth_amount"
    )


@query
def auth_requests(v: Views) -> DataFrame:
    """Authorise on unlock; a ride that could not start is reversed (events of type error)."""
    requests = v.sql(
        "select event_id, event_type, user_id rider_id, concat('qr', cast(event_id % (select count(*) from {part}) as string)) qr_code from {events}"
    )
    details = rides.unlock_details(requests, v.vehicles, v.riders, DEFAULT_RIDE_MINUTES)
    owned = lookup(details, v.owners, ["owner_id"], take=["currency_code"])
    amount = F.round(F.col("auth_amount"), 2).cast(money.MONEY)
    parts = (F.col("payment_method_id"), F.col("currency_code"), amount)
    return owned.select(
        "event_id",
        F.when(
            F.col("event_type") == "error", settlement.authorisation(settlement.AUTH_REVERSAL, *parts)
        )
        .otherwise(settlement.authorisation(settlement.AUTH_ONLY, *parts))
        .alias("request"),
    )


@query
def token_payment_allowed(v: Views) -> DataFrame:
    return rides.token_payment_allowed(_rated(v), v.riders).select("ride_id", "token_allowed")


def _rated(v: Views) -> DataFrame:
    """Stored rides with the owner's terms and the conversion rate."""
    with_owner = lookup(
        v.rides,
        v.owners,
        ["owner_id"],
        take=["currency_code", "commission_factor", "token_share"],
    )
    return rides.with_rate(with_owner, v.rates)


@query
def unset_method_guard(v: Views) -> DataFrame:
    wanted = v.rides.select("ride_id", "rider_id", "start_time")
    stored = v.rides.where("line <> 7")
    return rides.rides_without_method(wanted, stored).select("ride_id", "rider_id", "owner_id", "price")


@query
def rider_balance(v: Views) -> DataFrame:
    return rides.rider_balances(v.riders, _rated(v)).select("rider_id", "new_balance")


@query
def method_update(v: Views) -> DataFrame:
    choices = v.rides.where("k % 3 < 2").select("ride_id", (F.col("k") % 3 == 0).alias("chosen_token"))
    return rides.choose_method(v.rides, choices).select("ride_id", "paid_with_token", "token_awarded")


@query
def mark_paid(v: Views) -> DataFrame:
    captures = v.rides.where("k % 5 <> 0").select(
        "ride_id", F.concat(F.lit("new-"), F.col("k").cast("string")).alias("capture_id")
    )
    return rides.mark_paid(v.rides, captures).select("ride_id", "capture_transaction_id")


@query
def active_rides(v: Views) -> DataFrame:
    opens = v.rides.select("rider_id", "ride_id", "vehicle_id", "start_time", "distance")
    closes = v.rides.where(F.col("end_time").isNotNull()).select("ride_id")
    return rides.rides_in_progress(opens, closes)


@query
def invoice_rows(v: Views) -> DataFrame:
    paid = v.rides.where(F.col("end_time").isNotNull() & F.col("paid_with_token").isNotNull())
    cards = v.riders.where(F.col("card").isNotNull()).select(
        "payment_method_id",
        F.lpad((F.col("rider_id") % 10000).cast("string"), 4, "0").alias("card_last4"),
        F.col("card").alias("card_brand"),
    )
    return rides.invoice_rows(paid, v.riders, v.owners, cards)


# -- keyed tables -----------------------------------------------------------------------------


@query
def upsert_latest(v: Views) -> DataFrame:
    events = v.given("events").select("user_id", "ts", "event_id", "event_type", "value")
    cut = F.lit(EVENTS_CUT).cast("timestamp_ntz")
    stored = latest_per_key(events.where(F.col("ts") < cut), ["user_id"], ["ts", "event_id"])
    incoming = events.where(F.col("ts") >= cut)
    return keyed.merge_latest(stored, incoming, ["user_id"], ["ts", "event_id"])


@query
def keyed_update(v: Views) -> DataFrame:
    newest = telemetry.latest_fields(_telemetry(v), ["ts", "event_id"])
    reported = newest.select("device_id", F.col("battery_percentage").alias("level"), "state")
    current = v.vehicles.where("device_id <> ''").select("vehicle_id", "device_id", "status", "battery_percentage")
    return keyed.apply_update(current, reported, ["device_id"], {"battery_percentage": F.col("level")})


@query
def keyed_delete(v: Views) -> DataFrame:
    gone = v.rides.where(F.col("end_time").isNotNull()).select("ride_id")
    return keyed.delete_keys(v.rides.select("ride_id", "rider_id", "vehicle_id", "start_time"), gone, ["ride_id"])


@query
def job_state_ttl(v: Views) -> DataFrame:
    """A job per (user, hour); an error event marks its job failed. State as of half past the hour."""
    events = v.given("events").select(
        F.concat(F.col("user_id").cast("string"), F.lit("@"), F.date_format("ts", "yyyy-MM-dd HH")).alias("job_id"),
        F.when(F.col("event_type") == "error", "failed").otherwise("started").alias("state"),
        F.col("ts").alias("written_at"),
        "event_id",
    )
    last = latest_per_key(events, ["job_id"], ["written_at", "event_id"])
    stamped = keyed.with_expiry(last, "written_at", 300)
    half_past = F.date_trunc("hour", F.col("written_at").cast("timestamp")).cast("timestamp_ntz") + F.expr(
        "interval 30 minutes"
    )
    return keyed.live_rows(stamped, half_past).select("job_id", "state", "expires_at")


def _ledger(v: Views) -> DataFrame:
    """Owner ledger: settled owner transfers as signed entries."""
    return settlement.settled_deltas(v.token_messages).select(
        "event_id", "owner_id", F.col("delta").alias("amount")
    )


@query
def owner_balance_ledger(v: Views) -> DataFrame:
    return settlement.owner_positions(v.owners, _ledger(v)).select(
        "owner_id", "delta_cents", "position"
    )


@query
def export_rides(v: Views) -> DataFrame:
    rated = _rated(v)
    fiat, token = money.revenue_split(
        F.col("price"), F.col("commission_factor"), F.col("token_share"), F.col("rate"), F.col("currency_code"), TOKEN
    )
    return export.export_rows(
        rated.select("ride_id", "effective_date", "start_time", "end_time", "price", token.alias("token_revenue"))
    )


# -- routing ----------------------------------------------------------------------------------


def _payable(v: Views, source: DataFrame | None = None) -> DataFrame:
    since, until = routing.look_back(AS_OF, PAYMENT_INTERVAL_MS)
    return routing.payable_rides(v.rides if source is None else source, since, until)


@query
def payable_rides(v: Views) -> DataFrame:
    return _payable(v).select("ride_id", "owner_id", "end_time", "paid_with_token")


@query
def split_by_method(v: Views) -> DataFrame:
    tagged = routing.tag_route(
        v.rides.select("ride_id", "paid_with_token", "price"),
        {"token": F.col("paid_with_token"), "fiat": ~F.col("paid_with_token")},
        otherwise="undecided",
    )
    return tagged.select("ride_id", "route", "price")


@query
def txn_type_filter(v: Views) -> DataFrame:
    mine = routing.operator_transfers(v.token_messages).withColumn("branch", F.lit("operator"))
    theirs = routing.owner_transfers(v.token_messages).withColumn("branch", F.lit("owner"))
    return mine.unionByName(theirs).select("event_id", "branch", "transaction_type", "amount")


# -- settlement -------------------------------------------------------------------------------


def _settled(v: Views, **limits: int) -> DataFrame:
    positions = settlement.owner_positions(v.owners, _ledger(v))
    payable = _payable(v).select(
        "ride_id", "rider_id", "owner_id", "end_time", "price", "paid_with_token", "token_awarded",
        F.expr("case k % 2 when 0 then 'USD' else 'ILS' end").alias("currency_code"),
        F.expr("case when k % 13 > 0 then cast(0.2 + (k % 7) * 0.15 as decimal(11,6)) end").alias("conversion_rate"),
        _carried()[0],
    )
    return settlement.fold(settlement.with_owner_terms(payable, positions), **limits)


@query
def settlement_fold(v: Views) -> DataFrame:
    return _settled(v).select("owner_id", "ride_id", "price_cents", "covered", "left_cents")


@query
def settlement_fold_blocks(v: Views) -> DataFrame:
    """The fold with every owner of more than ten rides cut into blocks."""
    folded = _settled(v, max_rows=10, block_rows=2000)
    return folded.select("owner_id", "ride_id", "price_cents", "covered", "left_cents")


@query
def reward_owed(v: Views) -> DataFrame:
    return settlement.rewards_owed(_settled(v))


@query
def reward_messages(v: Views) -> DataFrame:
    return settlement.reward_messages(_settled(v))


@query
def payment_requests(v: Views) -> DataFrame:
    vendor = F.col("vendors")[0]
    return settlement.payment_requests(_settled(v), v.riders).select(
        "ride_id", "owner_id", "covered", "card_transaction_type", "vaulted_shopper_id", "currency", "amount",
        vendor["vendor_id"].alias("vendor_id"), vendor["commission_percent"].alias("commission_percent"),
    )


@query
def auth_reversals(v: Views) -> DataFrame:
    return settlement.auth_reversals(_settled(v))


@query
def payments(v: Views) -> DataFrame:
    """Every fourth capture fails; rides are captured a minute after their end."""
    captures = v.rides.select(
        "ride_id",
        F.expr("case when k % 4 > 0 then concat('new-', ride_id) end").alias("capture_id"),
        (F.col("end_time") + F.expr("interval '1' minute")).alias("captured_at"),
    )
    return settlement.payments(_settled(v), v.riders, captures)


@query
def settled_deltas(v: Views) -> DataFrame:
    return settlement.settled_deltas(v.token_messages).select("event_id", "owner_id", "delta")


@query
def txn_records(v: Views) -> DataFrame:
    wallets = settlement.with_wallets(v.token_messages, v.owners, OPERATOR_WALLET, RIDER_WALLET)
    return settlement.transaction_record(wallets, OPERATOR_WALLET, RIDER_WALLET, "ts")


@query
def txn_wallets(v: Views) -> DataFrame:
    wallets = settlement.with_wallets(v.token_messages, v.owners, OPERATOR_WALLET, RIDER_WALLET)
    return wallets.select("event_id", "from_address", "to_address", "amount")


@query
def pending_gate(v: Views) -> DataFrame:
    """Transfers waiting on owner and operator wallets; old ones of every fifth owner are in flight."""
    wallets = settlement.with_wallets(v.token_messages, v.owners, OPERATOR_WALLET, RIDER_WALLET)
    cut = F.lit(EVENTS_CUT).cast("timestamp_ntz")
    pending = wallets.where((F.col("ts") < cut) & (F.col("owner_id") % 5 == 0) & (F.col("transaction_type") == "OwnerToRider"))
    waiting = wallets.where(F.col("ts") >= cut)
    return settlement.pending_gate(waiting, pending, ["ts", "event_id"]).select(
        "event_id", "from_address", "gate"
    )


@query
def token_units(v: Views) -> DataFrame:
    units = money.to_token_units(F.col("amount"))
    return v.token_messages.select(
        "event_id",
        units.cast("string").alias("units"),
        money.from_token_units(units).alias("tokens"),
        money.fiat_price(F.col("amount"), F.lit("0.250000").cast(money.RATE)).cast("decimal(24,8)").alias("fiat"),
    )


@query
def operator_window_sum(v: Views) -> DataFrame:
    return settlement.operator_sums(v.token_messages).drop("owner_id")


@query
def owner_netting(v: Views) -> DataFrame:
    return settlement.owner_netting(v.token_messages)


@query
def settlement_union(v: Views) -> DataFrame:
    return settlement.settlement_batch(v.token_messages)


@query
def owner_delta_update(v: Views) -> DataFrame:
    """Token-paid rides credit the owner's counter and announce a rider-to-owner transfer."""
    paid = _rated(v).where("paid_with_token").select(
        "ride_id",
        "owner_id",
        money.token_price(F.col("price"), F.col("rate")).alias("amount"),
    )
    return keyed.ledger_sum(paid, "owner_id", "amount", "delta_cents")


# -- statistics -------------------------------------------------------------------------------


@query
def revenue_split(v: Views) -> DataFrame:
    fiat, token = money.revenue_split(
        F.col("price"), F.col("commission_factor"), F.col("token_share"), F.col("rate"), F.col("currency_code"), TOKEN
    )
    return _rated(v).select("ride_id", fiat.alias("fiat_revenue"), token.alias("token_revenue"))


def _daily(v: Views) -> DataFrame:
    return rollup.daily_vehicle_stats(_rated(v), TOKEN)


@query
def daily_vehicle_stats(v: Views) -> DataFrame:
    return _daily(v)


@query
def stats_backfill(v: Views) -> DataFrame:
    return rollup.backfill(_daily(v), F.lit(LAST_DAY)).drop("currency_code", "last_parking_image_url")


@query
def daily_vehicle_accumulate(v: Views) -> DataFrame:
    """The daily job's step: each day's figures on top of the stored totals of the day before."""
    daily = _daily(v)
    stored = rollup.backfill(daily, F.lit(LAST_DAY))
    return rollup.accumulate(daily, stored).select(
        "vehicle_id", "date", "rides_count", "rides_accumulate", "fiat_accumulate", "token_accumulate"
    )


@query
def daily_vehicle_carry(v: Views) -> DataFrame:
    daily = _daily(v)
    before = rollup.backfill(daily.where(F.col("date") < F.lit(STATS_DAY)), F.date_sub(F.lit(STATS_DAY), 1))
    return rollup.carry_forward(daily, v.vehicles, before, STATS_DAY)


@query
def daily_owner_stats(v: Views) -> DataFrame:
    stored = rollup.backfill(_daily(v), F.lit(LAST_DAY))
    return rollup.daily_owner_stats(stored)


@query
def parking_photo_update(v: Views) -> DataFrame:
    daily = _daily(v)
    photos = v.rides.where(F.col("end_time").isNotNull() & (F.col("rating") >= 3)).select(
        "owner_id", "vehicle_id", F.col("effective_date").alias("date"), "end_time", "ride_id", "parking_image_url"
    )
    return rollup.set_parking_photo(daily, photos).select(
        "owner_id", "vehicle_id", "date", "last_parking_image_url"
    )


# -- telemetry and search ---------------------------------------------------------------------


def _telemetry(v: Views) -> DataFrame:
    return v.iot_updates.withColumn("geohash", F.lit(None).cast("string"))


def _located_vehicles(v: Views) -> DataFrame:
    return v.vehicles.withColumn("geo_hash", geo.geohash(F.col("lat"), F.col("lon"))).withColumn(
        "device_state", F.lit("locked")
    )


@query
def telemetry_merge(v: Views) -> DataFrame:
    newest = telemetry.latest_fields(_telemetry(v), ["ts", "event_id"])
    return telemetry.merge_telemetry(_located_vehicles(v), newest).select(
        "vehicle_id", "battery_percentage", "device_state", "geo_hash"
    )


def _globe(v: Views) -> DataFrame:
    points = v.sql(
        """
        select event_id, cast((event_id * 7919 % 180000) * 0.001 - 90 as double) lat,
         cast((event_id * 104729 % 360000) * 0.001 - 180 as double) lon from {events}
        """
    )
    return points.select("event_id", geo.geohash(F.col("lat"), F.col("lon")).alias("geohash"))


@query
def geohash_cells(v: Views) -> DataFrame:
    centre_lat, centre_lon = geo.cell_centre(F.col("geohash"))
    return _globe(v).select(
        "event_id",
        "geohash",
        *geo.prefix_columns(F.col("geohash")),
        centre_lat.alias("centre_lat"),
        centre_lon.alias("centre_lon"),
    )


@query
def geohash_neighbours(v: Views) -> DataFrame:
    cells = _globe(v).select("event_id", geo.prefix(F.col("geohash"), 5).alias("cell"))
    return geo.with_neighbours(cells, "cell", "neighbour")


def _searches(v: Views) -> DataFrame:
    points = v.sql(
        """
        select event_id, cast(4 + event_id % 3 as int) prefix_length,
         cast(31.9 + (event_id * 41 % 1400) * 0.0005 as double) lat,
         cast(34.6 + (event_id * 59 % 1400) * 0.0005 as double) lon from {events}
        """
    )
    return points.withColumn("location_hash", geo.geohash(F.col("lat"), F.col("lon")))


@query
def proximity_search(v: Views) -> DataFrame:
    return telemetry.search_results(_searches(v), _located_vehicles(v))


# -- waiting and status -----------------------------------------------------------------------


COMMANDS = """
        select event_id, ts, case when user_id % 11 = 0 then '' else concat('dev-', cast(user_id as string)) end device_id,
         case event_type when 'view' then 'unlocked' else 'locked' end command
        from {events} where event_type in ('view', 'click')
"""


@query
def command_ack(v: Views) -> DataFrame:
    return intervals.acknowledged(v.sql(COMMANDS), v.iot_updates).select(
        "event_id", "device_id", "command", "ack_ts", "acked"
    )


@query
def command_sends(v: Views) -> DataFrame:
    answered = intervals.acknowledged(v.sql(COMMANDS), v.iot_updates)
    return intervals.sends(answered).select("event_id", "device_id", "command", "attempt", "sent_at")


@query
def payment_choice(v: Views) -> DataFrame:
    ended = v.rides.where(F.col("end_time").isNotNull()).select("ride_id", "end_time")
    choices = v.rides.where("end_time is not null and k % 7 <> 0").select(
        "ride_id",
        (F.col("end_time") + F.expr("make_dt_interval(0, 0, 0, cast((k * 37 + line * 11) % 900 - 200 as int))")).alias("ts"),
        F.col("paid_with_token").alias("by_token"),
    )
    return intervals.payment_choices(ended, choices).select("ride_id", "by_token")


LIFECYCLE_EVENTS = """
select event_id, user_id vehicle_id, ts,
 case event_id % 8 when 0 then 'unlock' when 1 then 'lock' when 2 then 'cordon' when 3 then 'uncordon'
  when 4 then 'garage' when 5 then 'ungarage' when 6 then 'cordon_garage' else 'ungarage_uncordon' end flow,
 case when event_type in ('view', 'click', 'purchase') or event_id % 8 in (2, 3) then 'request' when event_type = 'signup' then 'success' else 'failure' end kind
from {events}
"""


@query
def vehicle_lifecycle(v: Views) -> DataFrame:
    return lifecycle.replay(v.sql(LIFECYCLE_EVENTS), v.vehicles.select("vehicle_id", "status"))


@query
def plain_status(v: Views) -> DataFrame:
    changes = v.sql(
        """
        select user_id vehicle_id, event_id, ts, case event_type when 'view' then 'available' when 'click' then 'onmission' else 'maintenance' end status
        from {events}
        """
    )
    return lifecycle.plain_status(v.vehicles.select("vehicle_id", "status"), changes)


# -- streams ----------------------------------------------------------------------------------
# The given events arrive as a file stream; a closing tick at the end lets the watermark pass all of them.

STREAM_DELAY = "1 hour"


def _naive(df: DataFrame, *columns: str) -> DataFrame:
    """Instants without a zone, as the given files hold them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query
def windowed_stream(v: Views) -> DataFrame:
    out = drain(lambda ticks: settlement_stream.transfers(v.streamed("token_messages"), STREAM_DELAY, ticks), "windowed")
    return _naive(out, "window_start", "window_end")


def _exchanged(v: Views, build: Callable[..., DataFrame], label: str) -> DataFrame:
    commands, updates = v.sql(COMMANDS, events=v.arriving("events")), v.streamed("iot_updates")
    return drain(lambda ticks: build(commands, updates, delay=STREAM_DELAY, ticks=ticks), label)


@query
def command_ack_stream(v: Views) -> DataFrame:
    return _naive(_exchanged(v, waiting.acknowledgements, "acks"), "ts", "ack_ts")


@query
def command_sends_stream(v: Views) -> DataFrame:
    return _naive(_exchanged(v, waiting.sends, "sends"), "sent_at")


@query
def payment_choice_stream(v: Views) -> DataFrame:
    """Views end a ride; the rider chooses up to ten minutes before that or after it."""
    ended = v.sql(
        "select event_id ride_id, ts end_time from {events} where event_type = 'view'",
        events=v.arriving("events"),
    )
    choices = v.sql(
        """
        select event_id ride_id, ts + interval '1' second * cast(event_id % 1300 - 600 as int) ts, event_id % 2 = 0 by_token
        from {events} where event_type = 'view' and event_id % 5 <> 0
        """,
        events=v.arriving("events"),
    )
    out = drain(lambda ticks: waiting.payment_choices(ended, choices, delay=STREAM_DELAY, ticks=ticks), "choices")
    return _naive(out, "end_time")


@query
def vehicle_lifecycle_stream(v: Views) -> DataFrame:
    events = v.sql(LIFECYCLE_EVENTS, events=v.arriving("events"))
    vehicles = v.vehicles.select("vehicle_id", "status")
    known = events.join(vehicles.select("vehicle_id"), "vehicle_id")
    out = drain(lambda ticks: lifecycle_stream.replay_stream(known, vehicles), "lifecycle")
    return _naive(out, "ts")
