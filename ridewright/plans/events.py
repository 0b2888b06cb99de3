"""Micro-batch handlers of the message streams.

Each returns a function for ``foreachBatch``. What a batch stores goes to a folder of its own job and batch id,
so a batch that is run again after a lost driver or executor has the same effect once, and jobs that write the
same table do not disturb each other. Stored rows are looked up by key, so only files are read that may hold them.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridewright import schemas
from ridewright.functions import messages, money
from ridewright.operators import lifecycle, rides, settlement, telemetry
from ridewright.operators.lookup import latest_per_key, lookup, one_per_key
from ridewright.plans.store import Store, ride_key
from ridewright.sinks import tables, topics
from ridewright.sources.streams import dead_letters, decode, good
from ridewright.streaming import fleet, waiting

Handler = Callable[[DataFrame, int], None]

JOB_STATE_SECONDS = 300
SEARCH_SECONDS = 10

# The topic of each flow.
FLOW_TOPICS = {
    "unlock-vehicle": "unlock",
    "lock-vehicle": "lock",
    "garage-vehicle": "garage",
    "ungarage-vehicle": "ungarage",
    "cordon-vehicle": "cordon",
    "uncordon-vehicle": "uncordon",
    "cordon-garage-vehicle": "cordon_garage",
    "ungarage-uncordon-vehicle": "ungarage_uncordon",
}

ENDED = "ride_id string, end_time timestamp, token_allowed boolean"
CHOICES = "ride_id string, ts timestamp, by_token boolean"


def _decoded(store: Store, job: str, topic: str, bodies: DataFrame, batch_id: int) -> DataFrame:
    """Well-formed messages; the others are kept aside."""
    parsed = decode(bodies, "body", schemas.MESSAGES[topic])
    bad = dead_letters(parsed, "body")
    bad.write.mode("overwrite").text(f"{store.folder}/dead_letters/{job}/batch={batch_id}")
    return good(parsed)


def job_states(store: Store, rows: DataFrame, state: str, batch_id: int, job: str) -> None:
    """Append a state for each job (job_id, ts); readers ignore it after five minutes."""
    stamped = rows.where(F.col("job_id").isNotNull()).select(
        "job_id", F.lit(state).alias("state"), F.col("ts").alias("written_at")
    )
    tables.write_expiring(stamped, store.path("job_states"), "written_at", JOB_STATE_SECONDS, f"{job}-{state}", batch_id)


def job_state(store: Store, as_of: Column) -> DataFrame:
    """The newest state of each job that is still alive; a failure at the instant of the start counts as later."""
    alive = tables.live(store.spark, store.path("job_states"), as_of, "job_id string, state string, written_at timestamp")
    ranked = alive.withColumn("_failed", F.col("state") == "failed")
    return latest_per_key(ranked, ["job_id"], ["written_at", "_failed"]).drop("_failed")


# -- vehicles in service ------------------------------------------------------------------------


def flow_requests(store: Store, topic: str, default_minutes: float = 0.0) -> Handler:
    """Messages (body, ts) of one of the eight topics become requests that the fleet stream reads.

    A request carries what is stored for its vehicle. Requests for unknown vehicles, or by unknown riders, fail
    their job at once.
    """
    flow = FLOW_TOPICS[topic]

    def handle(bodies: DataFrame, batch_id: int) -> None:
        came = _decoded(store, flow, topic, bodies, batch_id)
        job = came.select(F.col("jobId").alias("job_id"), "ts")
        if lifecycle.FLOWS[flow].tracks_job:
            job_states(store, job, "started", batch_id, flow)
        none = F.lit(None).cast("string")
        if flow == "unlock":
            asked = came.select(
                "ts", F.col("qrCode").alias("qr_code"), F.col("riderId").alias("rider_id"), F.col("jobId").alias("job_id")
            )
            riders = store.read("riders", keys=asked.select("rider_id").distinct())
            detailed = rides.unlock_details(asked, store.read("vehicles"), riders, default_minutes)
            owned = lookup(
                detailed, store.read("owners", keys=detailed.select("owner_id")), ["owner_id"], take=["currency_code"], keep_misses=True
            )
            amount = F.round(F.col("auth_amount"), 2).cast(money.MONEY)
            request = settlement.authorisation(
                settlement.AUTH_ONLY, F.col("payment_method_id"), F.col("currency_code"), amount
            )
            wanted = owned.select("ts", "job_id", "rider_id", "vehicle_id", request.alias("details"))
        else:
            wanted = came.select("ts", F.col("jobId").alias("job_id"), none.alias("rider_id"), F.col("vehicleId").alias("vehicle_id"), none.alias("details"))
        vehicles = store.read("vehicles", keys=wanted.select("vehicle_id"))
        known = lookup(wanted, vehicles, ["vehicle_id"], take=["device_id", "vendor", "status", "device_state"])
        columns = [c.split()[0] for c in fleet.REQUESTS.split(", ")]
        rows = known.withColumn("flow", F.lit(flow)).select(*columns)
        staged = store.stage(f"{flow}_requests", batch_id, rows)
        store.land("vehicle_requests", flow, batch_id, staged)
        lost = job.join(staged.select("job_id"), "job_id", "left_anti")
        job_states(store, lost, "failed", batch_id, f"{flow}-unknown")

    return handle


def fleet_effects(store: Store, delay: str = fleet.DEFAULT_DELAY, ticks: DataFrame | None = None) -> DataFrame:
    """The stream of what the landed requests and device reports lead to, for :func:`apply_effects`."""
    asked = store.landed("vehicle_requests", fleet.REQUESTS)
    seen = store.landed("vehicle_sightings", fleet.SIGHTINGS)
    return fleet.effects(asked, seen, delay=delay, ticks=ticks)


def apply_effects(store: Store) -> Handler:
    """Statuses, failed jobs, device commands, opened rides and messages of the fleet stream."""

    def handle(effects: DataFrame, batch_id: int) -> None:
        rows = store.stage("fleet", batch_id, effects)
        last = latest_per_key(
            rows.select("vehicle_id", "moment", "step", "status", "in_transition"), ["vehicle_id"], ["moment", "step"]
        )
        store.set(
            "vehicles",
            last,
            "moment",
            {"status": F.col("status"), "in_transition": F.col("in_transition")},
            "fleet",
            batch_id,
        )
        flow, effect = F.col("flow"), F.col("effect")
        tracked = flow.isin([name for name, f in lifecycle.FLOWS.items() if f.tracks_job])
        failed = rows.where((effect == "refused") | ((effect == "failure") & tracked))
        job_states(store, failed.select("job_id", F.col("moment").alias("ts")), "failed", batch_id, "fleet")
        command = F.create_map(*[F.lit(x) for name, f in lifecycle.FLOWS.items() if f.command for x in (name, f.command)])
        sent = rows.where(effect == "send").withColumn("command", command[flow])
        lost = topics.to_topic(
            rows.where((effect == "failure") & (flow == "lock")),
            "lock-failed",
            messages.to_message(
                vehicleId=F.col("vehicle_id"), deviceId=F.col("device_id"), vendor=F.col("vendor"), jobId=F.col("job_id")
            ),
        )
        taken = topics.to_topic(rows.where((effect == "taken") & (flow == "unlock")), "authorisation", F.col("details"))
        store.send("fleet", batch_id, topics.device_commands(sent).unionByName(lost).unionByName(taken))
        begun = rows.where((effect == "success") & (flow == "unlock")).select(
            F.col("moment").alias("ts"), "rider_id", "vehicle_id"
        )
        placed = lookup(
            begun,
            store.read("vehicles", keys=begun.select("vehicle_id")),
            ["vehicle_id"],
            take=["geo_hash", "battery_percentage"],
            keep_misses=True,
        )
        opened = rides.open_rides(placed).withColumn(
            "ride_id", ride_key(F.col("rider_id"), F.col("vehicle_id"), F.col("start_time"))
        )
        store.put("active_rides", opened, "start_time", "fleet", batch_id)

    return handle


def authorised(store: Store) -> Handler:
    """Gateway answers (rider_id, ride_id, auth_transaction_id, ts) are noted on the open ride."""

    def handle(answers: DataFrame, batch_id: int) -> None:
        columns = {"auth_transaction_id": F.col("auth_transaction_id")}
        store.set("active_rides", answers, "ts", columns, "authorised", batch_id)

    return handle


def telemetry_updates(store: Store) -> Handler:
    """Telemetry messages: each field of a device's vehicles takes the newest value, by its own instant.

    The instants are stored with the values, so batches may come in any order. All reports of a state go on to
    the fleet stream.
    """

    def handle(bodies: DataFrame, batch_id: int) -> None:
        updates = _decoded(store, "telemetry", "iot-updates", bodies, batch_id).select(
            F.col("deviceId").alias("device_id"),
            F.col("timestamp").alias("ts"),
            F.col("batteryPercentage").alias("battery_percentage"),
            F.col("batteryVoltage").alias("battery_voltage"),
            "state",
            "geohash",
            F.col("latitude").cast("double").alias("lat"),
            F.col("longitude").cast("double").alias("lon"),
        )
        reported = updates.where(F.col("device_id") != "")
        vehicles = store.read("vehicles").where(F.col("device_id") != "").select(
            "vehicle_id", "device_id", "battery_alpha", "battery_beta"
        )
        newest = telemetry.timed_fields(reported, "ts").join(vehicles, "device_id")
        staged = store.stage(
            "telemetry",
            batch_id,
            newest.withColumn(
                "level",
                messages.battery_level(
                    F.col("battery_percentage"), F.col("battery_voltage"), F.col("battery_alpha"), F.col("battery_beta")
                ),
            ),
        )
        store.table("vehicles").set_all(
            [
                (staged, "battery_ts", {"battery_percentage": F.col("level")}),
                (staged, "state_ts", {"device_state": F.col("state")}),
                (staged, "geohash_ts", {"geo_hash": F.col("geohash")}),
            ],
            "telemetry",
            batch_id,
        )
        seen = reported.where(F.col("state").isNotNull()).join(vehicles, "device_id")
        store.land("vehicle_sightings", "telemetry", batch_id, seen.select("vehicle_id", "ts", "state"))

    return handle


# -- the end of a ride --------------------------------------------------------------------------


def end_ride(store: Store, zones: DataFrame, zone_prefix: int) -> Handler:
    """End-ride messages (body, ts): priced summaries, the lock request, and the ride is closed.

    A message ends its rider's latest ride that had begun by then. Several messages may end several rides of a
    rider; of those for one ride the first counts. Messages that end nothing are kept aside.
    """

    def handle(bodies: DataFrame, batch_id: int) -> None:
        came = _decoded(store, "end_ride", "end-ride", bodies, batch_id).select(
            F.col("riderId").alias("rider_id"),
            F.col("parkingImageUrl").alias("parking_image_url"),
            F.col("paymentMethodToken").alias("chosen_token"),
            F.col("ts").alias("end_time"),
        )
        active = store.read("active_rides", keys=came.select("rider_id").distinct())
        candidates = came.join(
            active.select("rider_id", "ride_id", "start_time"), "rider_id"
        ).where(F.col("start_time") <= F.col("end_time"))
        # the latest ride of each message, then the first message of each ride
        message = ["rider_id", "end_time", "parking_image_url", "chosen_token"]
        of_message = latest_per_key(candidates, message, ["start_time", "ride_id"])
        once = one_per_key(of_message.drop("start_time"), ["ride_id"], ["end_time", "parking_image_url"])
        vehicle_of = lookup(once, active, ["ride_id"], take=["vehicle_id"])
        vehicles = store.read("vehicles", keys=vehicle_of.select("vehicle_id"))
        owners = store.read("owners")
        enriched = rides.enrich_end_ride(once.drop("rider_id"), active, vehicles, owners, store.read("rates"))
        vendors = lookup(enriched.drop("vendor_id"), vehicles, ["vehicle_id"], take=["vendor"])
        priced = rides.with_local_date(rides.price_rides(vendors), zones, zone_prefix)
        riders = store.read("riders", keys=priced.select("rider_id"))
        done = store.stage("end_ride", batch_id, rides.token_payment_allowed(priced, riders))
        summaries = rides.ride_summaries(done)
        store.put("rides_summary", summaries, "end_time", "end_ride", batch_id)
        store.put("rides_ended", with_end_day(summaries), "end_time", "end_ride", batch_id)
        photos = summaries.select(
            "vehicle_id", F.col("effective_date").alias("date"), "parking_image_url", "end_time"
        )
        store.set(
            "vehicle_stats_daily",
            latest_per_key(photos.dropna(), ["vehicle_id", "date"], ["end_time", "parking_image_url"]),
            "end_time",
            {"last_parking_image_url": F.col("parking_image_url")},
            "end_ride",
            batch_id,
        )
        locks = topics.to_topic(
            done,
            "lock-vehicle",
            rides.lock_command(F.col("device_id"), F.col("vendor"), F.col("vehicle_id")),
        )
        store.send("end_ride", batch_id, locks)
        store.land("ended_rides", "end_ride", batch_id, done.select("ride_id", "end_time", "token_allowed"))
        own = done.where(F.col("chosen_token").isNotNull())
        store.land(
            "payment_choices",
            "end_ride",
            batch_id,
            own.select("ride_id", F.col("end_time").alias("ts"), F.col("chosen_token").alias("by_token")),
        )
        store.remove("active_rides", done.select("rider_id", "ride_id", "end_time"), "end_time", "end_ride", batch_id)
        kept = done.select("rider_id", "end_time").distinct()
        unused = came.join(kept, ["rider_id", "end_time"], "left_anti")
        unused.select(F.to_json(F.struct(*unused.columns)).alias("value")).write.mode("overwrite").text(
            f"{store.folder}/dead_letters/end_ride-unknown/batch={batch_id}"
        )

    return handle


def with_end_day(summaries: DataFrame) -> DataFrame:
    return summaries.withColumn("end_day", F.to_date("end_time"))


def payment_choice(store: Store) -> Handler:
    """Choices (body, ts) of riders, made during the ride or after it."""

    def handle(bodies: DataFrame, batch_id: int) -> None:
        made = _decoded(store, "payment_choice", "payment-choice", bodies, batch_id).select(
            ride_key(F.col("riderId"), F.col("vehicleId"), F.col("startTime")).alias("ride_id"),
            "ts",
            F.col("paymentMethodToken").alias("by_token"),
        )
        store.land("payment_choices", "payment_choice", batch_id, made.dropna())

    return handle


def chosen_rides(store: Store, delay: str = waiting.DEFAULT_DELAY, ticks: DataFrame | None = None) -> DataFrame:
    """The stream of ended rides with the rider's choice, for :func:`apply_choices`."""
    ended = store.landed("ended_rides", ENDED).drop("token_allowed")
    return waiting.payment_choices(ended, store.landed("payment_choices", CHOICES), delay=delay, ticks=ticks)


def apply_choices(store: Store) -> Handler:
    """Each decided ride asks for its balances to be booked, and is printed."""

    def handle(decided: DataFrame, batch_id: int) -> None:
        once = one_per_key(decided.withColumn("end_day", F.to_date("end_time")), ["ride_id"], ["end_time"])
        staged = store.stage("choices", batch_id, once)
        ended = store.read("rides_ended", keys=staged.select("end_day")).drop("paid_with_token", "end_day", "end_time")
        known = staged.join(ended, "ride_id").withColumnRenamed("by_token", "paid_with_token")
        body = rides.balance_command(
            F.col("rider_id"), F.col("vehicle_id"), F.col("start_time"), F.col("paid_with_token")
        )
        store.send("choices", batch_id, topics.to_topic(known, "update-balance", body))
        store.land("invoices", "choices", batch_id, known)

    return handle


def update_balance(store: Store) -> Handler:
    """Balance messages: store the payment method once and book both balances."""

    def handle(bodies: DataFrame, batch_id: int) -> None:
        wanted = _decoded(store, "balance", "update-balance", bodies, batch_id).select(
            ride_key(F.col("riderId"), F.col("vehicleId"), F.col("startTime")).alias("ride_id"),
            F.col("paymentMethodToken").alias("chosen_token"),
            F.to_date("startTime").alias("_day"),
            "ts",
        )
        once = one_per_key(wanted.dropna(), ["ride_id"], ["ts", "chosen_token"])
        # the local day of a start is the UTC day or a neighbour of it
        days = [r[0] for r in once.select("_day").distinct().collect()]
        near = sorted({d + timedelta(days=k) for d in days for k in (-1, 0, 1)})
        open_rides = store.read("rides_summary", parts=near).where(F.col("paid_with_token").isNull())
        done = store.stage(
            "balance",
            batch_id,
            open_rides.join(once.drop("_day"), "ride_id").select(
                "ride_id",
                "rider_id",
                "owner_id",
                "effective_date",
                "end_time",
                "price",
                F.col("conversion_rate").alias("rate"),
                "token_awarded",
                "chosen_token",
                "ts",
            ),
        )
        change = money.rider_token_change(
            F.col("chosen_token"), F.col("price"), F.col("rate"), F.col("token_awarded")
        )
        store.append_ledger(
            "rider_ledger",
            done.select("rider_id", change.cast(money.MONEY).alias("amount")),
            "balance",
            batch_id,
        )
        credit = done.where("chosen_token").select(
            "ride_id",
            "owner_id",
            F.col("end_time").alias("ts"),
            money.token_price(F.col("price"), F.col("rate")).alias("amount"),
        )
        store.append_ledger("owner_ledger", credit.select("owner_id", "amount"), "balance", batch_id)
        store.send(
            "balance",
            batch_id,
            topics.to_topic(
                credit,
                "token-payment",
                messages.to_message(
                    transactionType=F.lit("RiderToOwner"),
                    ownerId=F.col("owner_id"),
                    amount=F.col("amount"),
                ),
            ),
        )
        columns = {
            "paid_with_token": F.col("chosen_token"),
            "token_awarded": F.when(F.col("chosen_token"), F.lit(0)),
        }
        store.set("rides_summary", done, "ts", columns, "balance", batch_id)
        store.set("rides_ended", with_end_day(done), "ts", columns, "balance", batch_id)

    return handle


# -- search -------------------------------------------------------------------------------------


def search(store: Store) -> Handler:
    """Search messages (body, ts): result pages that live ten seconds."""

    def handle(bodies: DataFrame, batch_id: int) -> None:
        asked = _decoded(store, "search", "search-vehicles", bodies, batch_id).select(
            F.col("locationHash").alias("location_hash"),
            F.col("searchPrefixLength").cast("int").alias("prefix_length"),
            "ts",
        )
        cells = asked.dropna()
        found = telemetry.search_results(cells, store.read("vehicles"))
        cell = F.left("location_hash", F.col("prefix_length")).alias("prefix")
        newest = cells.groupBy("prefix_length", cell).agg(F.max("ts").alias("written_at"))
        stamped = lookup(found, newest, ["prefix_length", "prefix"], take=["written_at"])
        tables.write_expiring(stamped, store.path("search_results"), "written_at", SEARCH_SECONDS, "search", batch_id)

    return handle


def search_result(store: Store, as_of: Column) -> DataFrame:
    """Result pages still alive at ``as_of``, the newest of each search."""
    schema = "prefix_length int, prefix string, page bigint, vehicles_found bigint, search_results string, written_at timestamp"
    alive = tables.live(store.spark, store.path("search_results"), as_of, schema)
    return latest_per_key(alive, ["prefix_length", "prefix", "page"], ["written_at"])
