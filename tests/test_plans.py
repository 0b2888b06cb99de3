"""A ride from unlock to payment through the stored tables, with repeated batches."""

import json
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ridewright import schemas
from ridewright.functions import geo
from ridewright.plans import batch, events
from ridewright.plans.store import Store
from ridewright.streaming.run import CLOSING, land_tick, landed_ticks, start_batches

pytestmark = pytest.mark.usefixtures("interpreted")

NOON = datetime(2024, 5, 1, 12, 0, 0)


def bodies(spark, rows):
    texts = [(text if isinstance(text, str) else json.dumps(text), ts) for text, ts in rows]
    return spark.createDataFrame(texts, "body string, ts timestamp")


@pytest.fixture
def store(spark, folder):
    store = Store(spark, folder)
    cells = ["u4pruydqqvj8", "u4pruydqqvj9", "s00000000000"]
    # the statuses from which the flows begin
    statuses = ["available", "available", "available", "notavailable", "available", "notavailable", "maintenance", "available", "maintenance"]
    vehicles = spark.createDataFrame(
        [
            (f"v{i}", "o1", status, f"QR{i}", f"dev{i}", "acme", None, "op", Decimal("1.00"), Decimal("0.50"), None, Decimal("0.1"), 50, Decimal(10), Decimal(-300), cells[min(i, 2)], None, False)
            for i, status in enumerate(statuses)
        ],
        schemas.TABLES["vehicles"],
    )
    owners = spark.createDataFrame(
        [("o1", "Owner", "USD", Decimal("0.1"), Decimal("0.5"), Decimal("1000.00"), "vendor-1", "w1")],
        schemas.TABLES["owners"],
    )
    riders = spark.createDataFrame([("r1", Decimal("5.00"), "shopper-1"), ("r2", None, "shopper-2")], schemas.TABLES["riders"])
    rates = spark.createDataFrame([("USD", Decimal("0.25"), NOON)], schemas.TABLES["rates"])
    for name, rows in (("vehicles", vehicles), ("owners", owners), ("riders", riders), ("rates", rates)):
        store.put(name, rows, F.lit(NOON - timedelta(days=1)), "load", 0)
    return store


class Fleet:
    """The fleet stream of a store, run over what has landed so far, up to a tick."""

    def __init__(self, store):
        self.store, self.ticks = store, f"{store.folder}/ticks"
        land_tick(store.spark, self.ticks, None)

    def run(self, until=CLOSING):
        land_tick(self.store.spark, self.ticks, until)
        out = events.fleet_effects(self.store, "0 seconds", landed_ticks(self.store.spark, self.ticks))
        start_batches(out, events.apply_effects(self.store), f"{self.store.folder}/fleet-checkpoint").awaitTermination()

    def ask(self, topic, batch, *rows):
        handle = events.flow_requests(self.store, topic, 5.0)
        handle(bodies(self.store.spark, rows), batch)
        handle(bodies(self.store.spark, rows), batch)  # a repeated batch changes nothing

    def report(self, batch, *rows):
        told = [({"deviceId": d, "timestamp": t.strftime("%Y-%m-%dT%H:%M:%S.000Z"), "state": s}, t) for d, t, s in rows]
        events.telemetry_updates(self.store)(bodies(self.store.spark, told), batch)

    def status(self):
        return {r.vehicle_id: (r.status, r.in_transition) for r in self.store.read("vehicles").collect()}

    def jobs(self, when):
        return {r.job_id: r.state for r in events.job_state(self.store, F.lit(when)).collect()}

    def sent(self):
        rows = self.store.spark.read.parquet(f"{self.store.folder}/outbox/fleet").collect()
        return sorted((r.topic, r.value) for r in rows)


def test_all_eight_flows(spark, store):
    fleet = Fleet(store)
    lock = lambda i, job: {"vehicleId": f"v{i}", "deviceId": f"dev{i}", "vendor": "acme", "jobId": job}
    fleet.ask("unlock-vehicle", 0, ({"qrCode": "qr0", "riderId": "r1", "jobId": "u0"}, NOON), ({"qrCode": "qr0", "riderId": "r2", "jobId": "u0-late"}, NOON + timedelta(seconds=1)), ({"qrCode": "nope", "riderId": "r2", "jobId": "u-lost"}, NOON), ("{broken", NOON))
    fleet.ask("unlock-vehicle", 1, ({"qrCode": "QR1", "riderId": "r2", "jobId": "u1"}, NOON))
    fleet.ask("cordon-vehicle", 0, ({"vehicleId": "v2", "jobId": "c2"}, NOON))
    fleet.ask("uncordon-vehicle", 0, ({"vehicleId": "v3", "jobId": "c3"}, NOON))
    fleet.ask("cordon-garage-vehicle", 0, (lock(4, "g4"), NOON))
    fleet.ask("garage-vehicle", 0, (lock(5, "g5"), NOON), (lock(0, "g0"), NOON + timedelta(seconds=30)))
    fleet.ask("ungarage-vehicle", 0, (lock(6, "g6"), NOON))
    fleet.ask("ungarage-uncordon-vehicle", 0, (lock(8, "g8"), NOON))
    soon = NOON + timedelta(seconds=90)
    fleet.report(0, ("dev0", soon, "unlocked"), ("dev4", soon, "unlocked"), ("dev5", soon, "locked"), ("dev6", soon, "locked"))
    fleet.run(NOON + timedelta(seconds=120))
    assert fleet.status() == {
        "v0": ("onmission", False), "v1": ("available", True), "v2": ("notavailable", False), "v3": ("available", False), "v4": ("maintenance", False),
        "v5": ("notavailable", True), "v6": ("notavailable", False), "v7": ("available", False), "v8": ("maintenance", True),
    }
    states = fleet.jobs(NOON + timedelta(seconds=121))
    assert {j for j, s in states.items() if s == "failed"} == {"u0-late", "u-lost", "g0"}
    assert {j for j, s in states.items() if s == "started"} == {"u0", "u1", "c2", "c3", "g4", "g5", "g6", "g8"}
    # one rider has the vehicle, although two asked for it
    assert [(r.rider_id, r.vehicle_id, r.start_time) for r in store.read("active_rides").collect()] == [("r1", "v0", soon)]
    assert spark.read.text(f"{store.folder}/dead_letters/unlock/batch=0").count() == 1
    taken = [v for t, v in fleet.sent() if t == "authorisation"]
    assert sorted(json.loads(v)["vaultedShopperId"] for v in taken) == ["shopper-1", "shopper-2"]
    assert json.loads(taken[0])["amount"] == 3.5

    # the limit passes: commands were sent six times, jobs failed, vehicles are released
    fleet.ask("lock-vehicle", 0, (lock(0, None), NOON + timedelta(seconds=200)), (lock(7, "l7"), NOON + timedelta(seconds=200)))
    fleet.run(NOON + timedelta(seconds=700))
    got = fleet.status()
    assert {v: got[v] for v in ("v0", "v1", "v5", "v7", "v8")} == {
        "v0": ("maintenance", False), "v1": ("available", False), "v5": ("notavailable", False), "v7": ("available", False), "v8": ("maintenance", False),
    }
    late = fleet.jobs(NOON + timedelta(seconds=361))
    assert {j for j, s in late.items() if s == "failed"} >= {"u1", "g5", "g8", "l7"}
    to_device = [json.loads(v) for t, v in fleet.sent() if t == "iot-commands-acme"]
    assert sum(c == {"deviceId": "dev1", "vendor": "acme", "command": "unlocked"} for c in to_device) == 6
    assert sum(c["deviceId"] == "dev0" and c["command"] == "unlocked" for c in to_device) == 2
    assert [json.loads(v) for t, v in fleet.sent() if t == "lock-failed"] == [{"vehicleId": "v0", "deviceId": "dev0", "vendor": "acme"}]


def test_a_ride(spark, store):
    fleet = Fleet(store)
    fleet.ask("unlock-vehicle", 0, ({"qrCode": "qr0", "riderId": "r1", "jobId": "j1"}, NOON))
    fleet.report(0, ("dev0", NOON, "unlocked"))
    fleet.run(NOON + timedelta(seconds=5))
    ride = store.read("active_rides").first()
    answer = spark.createDataFrame([(ride.rider_id, ride.ride_id, "auth-1", NOON + timedelta(seconds=9))], "rider_id string, ride_id string, auth_transaction_id string, ts timestamp")
    events.authorised(store)(answer, 0)

    zones = spark.createDataFrame([("u4pru", "Asia/Tokyo")], "cell string, tz_id string")
    over = NOON + timedelta(minutes=10, seconds=59)
    end = events.end_ride(store, zones, 5)
    ended = bodies(spark, [({"riderId": "r1", "jobId": "j3", "parkingImageUrl": "img"}, over), ({"riderId": "r1"}, over + timedelta(seconds=1)), ({"riderId": "r9"}, over)])
    for _ in range(2):  # a repeated batch changes nothing
        end(ended, 0)
        assert store.read("active_rides").count() == 0
        rides = store.read("rides_summary").collect()
        assert len(rides) == 1
        ride = rides[0]
        assert (ride.price, ride.commission, ride.token_awarded) == (Decimal("6.00"), Decimal("0.60"), Decimal("2.40"))
        assert ride.effective_date == date(2024, 5, 1) and ride.paid_with_token is None and ride.auth_transaction_id == "auth-1"
        sent = spark.read.parquet(f"{store.folder}/outbox/end_ride/batch=0").collect()
        assert [r.topic for r in sent] == ["lock-vehicle"]
    unused = spark.read.text(f"{store.folder}/dead_letters/end_ride-unknown/batch=0").collect()
    assert sorted(json.loads(r.value)["rider_id"] for r in unused) == ["r1", "r9"]

    # the choice was made during the ride
    choice = {"riderId": "r1", "vehicleId": "v0", "startTime": "2024-05-01T12:00:00.000Z", "paymentMethodToken": True}
    events.payment_choice(store)(bodies(spark, [(choice, NOON + timedelta(minutes=3))]), 0)
    land_tick(spark, fleet.ticks, CLOSING)
    decided = events.chosen_rides(store, "0 seconds", landed_ticks(spark, fleet.ticks))
    start_batches(decided, events.apply_choices(store), f"{store.folder}/choice-checkpoint").awaitTermination()
    outbox = spark.read.parquet(f"{store.folder}/outbox/choices").collect()
    assert [(r.topic, json.loads(r.value)) for r in outbox] == [("update-balance", choice)]
    assert spark.read.option("recursiveFileLookup", "true").parquet(store.path("invoices")).count() == 1

    balance = events.update_balance(store)
    body = outbox[0].value
    balance(bodies(spark, [(body, over), (body, over)]), 0)
    balance(bodies(spark, [(body, over + timedelta(seconds=1))]), 1)  # already chosen: ignored
    ride = store.read("rides_summary").first()
    assert ride.paid_with_token is True and ride.token_awarded == 0
    # 6.00 at 0.25 are 24 tokens
    assert {r.rider_id: r.balance for r in batch.rider_balances(store).collect()} == {"r1": Decimal("-19.00"), "r2": Decimal("0.00")}
    assert store.ledger("owner_ledger").collect()[0].amount == Decimal("24.00")

    as_of = over + timedelta(minutes=1)
    settled = batch.rider_payment(store, as_of, 600_000, 1)
    # a ride paid with tokens stays out of the fold and books no award; what was authorised is given back
    assert [(r.covered, r.price_cents) for r in settled.collect()] == [(None, None)]
    reversal = spark.read.parquet(f"{store.folder}/staged/auth_reversals/batch=1").first()
    assert json.loads(reversal.request) == {"cardTransactionType": "AUTH_REVERSAL", "transactionId": "auth-1"}
    assert batch.rider_payment(store, as_of, 600_000, 2).count() == 0
    captures = spark.createDataFrame([], "ride_id string, capture_id string, captured_at timestamp")
    batch.apply_captures(store, 1, captures)
    assert store.read("rides_summary").first().capture_transaction_id == "paid-with-token"

    for _ in range(2):
        batch.daily_stats(store, NOON, "TOK", 0)
    batch.daily_stats(store, NOON + timedelta(days=1), "TOK", 1)
    days = {(r.vehicle_id, r.date.day): (r.rides_count, r.rides_accumulate) for r in store.read("vehicle_stats_daily").collect()}
    assert days == {("v0", 1): (1, 1), ("v0", 2): (0, 1), ("v0", 3): (0, 1)}
    owner = {r.date.day: r.fiat_accumulate for r in store.read("owner_stats_daily").collect()}
    assert owner == {1: Decimal("2.7"), 2: Decimal("2.7"), 3: Decimal("2.7")}
    # a run reads the days it needs and no other
    assert {f.split("part=")[1][:10] for f in store.read("rides_summary", parts=[date(2024, 5, 1)]).inputFiles()} == {"2024-05-01"}
    store.upkeep(NOON + timedelta(days=2))
    assert store.read("rides_summary").first().capture_transaction_id == "paid-with-token"


def ended_rides(spark, store, *rows):
    """Rides (ride, price, minutes after noon) of rider r1 that ended and are to be paid by card."""
    full = spark.createDataFrame(
        [(n, NOON + timedelta(minutes=m), Decimal(p)) for n, p, m in rows], "ride_id string, end_time timestamp, price decimal(18,2)"
    ).selectExpr(
        "*", "'r1' rider_id", "'v0' vehicle_id", "'o1' owner_id", "end_time - interval 3 days start_time", "date '2024-04-28' effective_date",
        "'USD' currency_code", "cast(0.5 as decimal(11,6)) conversion_rate", "false paid_with_token", "cast(1 as decimal(28,8)) token_awarded",
        "to_date(end_time) end_day",
    )
    missing = [f for f in schemas.TABLES["rides_ended"].fields if f.name not in full.columns]
    rides = full.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])
    for name in ("rides_summary", "rides_ended"):
        store.put(name, rides, "end_time", "load", 0)


def test_captures_and_retries(spark, store):
    ended_rides(spark, store, ("a", "10.00", 1), ("b", "4.00", 2), ("c", "5000.00", 3))
    entry = spark.createDataFrame([("o1", Decimal("0.00"))], "owner_id string, amount decimal(18,2)")
    store.append_ledger("owner_ledger", entry, "load", 0)
    as_of = NOON + timedelta(minutes=5)
    settled = {r.ride_id: r.covered for r in batch.rider_payment(store, as_of, 600_000, 1).collect()}
    assert settled == {"a": True, "b": True, "c": False}
    booked = sorted(r.amount for r in store.ledger("owner_ledger").collect())
    answers = lambda *rows: spark.createDataFrame(rows, "ride_id string, capture_id string, captured_at timestamp")
    for _ in range(2):
        batch.apply_captures(store, 1, answers(("a", "cap-a", as_of), ("b", None, as_of)))
    # c is not answered yet, b failed and is asked for again on the same terms
    batch.rider_payment(store, as_of + timedelta(minutes=1), 600_000, 2)
    again = spark.read.parquet(f"{store.folder}/staged/payment_requests/batch=2").collect()
    assert [(r.ride_id, r.covered, r.amount) for r in again] == [("b", True, Decimal("4.00"))]
    assert sorted(r.amount for r in store.ledger("owner_ledger").collect()) == booked
    batch.apply_captures(store, 2, answers(("b", "cap-b", as_of + timedelta(minutes=2))))
    batch.rider_payment(store, as_of + timedelta(minutes=3), 600_000, 3)
    assert spark.read.parquet(f"{store.folder}/staged/payment_requests/batch=3").count() == 0
    paid = {r.ride_id: (r.transaction_id, r.vaulted_shopper_id, r.amount, r.reward_commission_factor) for r in store.read("payments").collect()}
    assert paid == {"a": ("cap-a", "shopper-1", Decimal("10.00"), 0), "b": ("cap-b", "shopper-1", Decimal("4.00"), 0)}
    marks = {r.ride_id: r.capture_transaction_id for r in store.read("rides_ended").collect()}
    assert marks == {"a": "cap-a", "b": "cap-b", "c": None}


def test_transfers_wait_for_their_sender(spark, store):
    """Batches of random answers against a queue for each sender in plain Python."""
    import random

    draw = random.Random(8)
    kinds = ["NetworkOperatorToRider", "OwnerToRider", "RiderToOwner"]
    queues, flying, ledger, failed = {"op": [], "ri": []}, {}, Decimal(0), set()
    for turn in range(3):
        rows = []
        for n in range(4):
            kind = draw.choice(kinds)
            end = NOON + timedelta(hours=4 * (4 * turn + n))
            rows.append((end - timedelta(hours=4), end, kind, None if kind == kinds[0] else "o1", Decimal(draw.randrange(1, 9))))
        frame = spark.createDataFrame(rows, "window_start timestamp, window_end timestamp, transaction_type string, owner_id string, amount decimal(28,2)")
        for _ in range(2):
            batch.queue_transfers(store, frame, "op", "ri", turn)
        for _, end, kind, owner, amount in rows:
            name = "/".join(x for x in (end.strftime("%Y%m%d%H%M%S"), kind, owner) if x)
            queues["ri" if kind == kinds[2] else "op"].append((name, kind, amount))
        moment = NOON + timedelta(days=10 + turn)
        for _ in range(2):
            out = batch.release_transfers(store, moment, turn)
        for sender, queue in queues.items():
            if sender not in flying and queue:
                flying[sender] = queue.pop(0)
                assert flying[sender][0] in {r.transfer_id for r in out.collect()}
        assert {r.transfer_id for r in store.read("transfers").where("state = 'pending'").collect()} == {f[0] for f in flying.values()}
        waiting = {r.transfer_id for r in store.read("transfers").where("state = 'queued'").collect()}
        assert waiting == {q[0] for queue in queues.values() for q in queue}
        answers = [(name, draw.random() < 0.7, moment + timedelta(hours=1)) for name, *_ in flying.values()] + [("unknown", True, moment)]
        for _ in range(2):
            batch.complete_transfers(store, spark.createDataFrame(answers, "transfer_id string, ok boolean, ts timestamp"), turn)
        for sender, (name, kind, amount) in list(flying.items()):
            if dict((a, b) for a, b, _ in answers)[name]:
                ledger += amount if kind == kinds[1] else -amount if kind == kinds[2] else 0
            else:
                failed.add(name)
        flying.clear()
        assert sum((r.amount for r in store.ledger("owner_ledger").collect()), Decimal(0)) == ledger
    lost = spark.read.option("recursiveFileLookup", "true").parquet(store.path("failed_transfers"))
    assert {r.transfer_id for r in lost.collect()} == failed


@pytest.mark.parametrize("order", [(0, 1), (1, 0)])
def test_telemetry_in_any_order(spark, store, order):
    at = "2024-05-01T12:00:0{}.000Z"
    update = events.telemetry_updates(store)
    batches = [
        [({"deviceId": "dev0", "timestamp": at.format(2), "batteryVoltage": 35.25}, NOON), ({"deviceId": "dev2", "timestamp": at.format(1), "batteryPercentage": 7}, NOON)],
        [({"deviceId": "dev0", "timestamp": at.format(1), "state": "locked", "geohash": "u4pruydqqvjb", "batteryPercentage": 1}, NOON)],
    ]
    for n, which in enumerate(order):
        update(bodies(spark, batches[which]), n)
        update(bodies(spark, batches[which]), n)
    got = {r.vehicle_id: (r.battery_percentage, r.geo_hash, r.device_state) for r in store.read("vehicles").collect()}
    assert [got[v] for v in ("v0", "v1", "v2")] == [(52, "u4pruydqqvjb", "locked"), (50, "u4pruydqqvj9", None), (7, "s00000000000", None)]


def test_search(spark, store):
    look = events.search(store)
    look(bodies(spark, [({"locationHash": "u4pruydqqvj0", "searchPrefixLength": 6}, NOON), ({"locationHash": "zzzzzzzzzzzz", "searchPrefixLength": 5}, NOON)]), 0)
    alive = F.lit("2024-05-01 12:00:09").cast("timestamp")
    pages = {r.prefix: [c["id"] for c in json.loads(r.search_results)] for r in events.search_result(store, alive).collect()}
    assert pages == {"u4pruy": ["v0", "v1"], "zzzzz": []}
    late = F.lit("2024-05-01 12:00:10").cast("timestamp")
    assert events.search_result(store, late).count() == 0


def test_rates_keep_the_newest(spark, store):
    body = '{"data":{"TOK":{"quote":{"USD":{"price":%s},"EUR":{"price":1}}}}}'
    rows = [(200, body % "0.5", NOON + timedelta(minutes=1)), (200, body % "0.7", NOON + timedelta(minutes=2)), (500, body % "9", NOON + timedelta(minutes=3)), (200, "{", NOON)]
    batch.conversion_rates(store, spark.createDataFrame(rows, "status int, body string, ts timestamp"), "TOK", 0)
    assert [(r.currency_code, r.rate) for r in store.read("rates").collect()] == [("USD", Decimal("0.700000"))]


def test_paged_search_is_whole(spark):
    from ridewright.operators import telemetry

    vehicles = spark.range(300).select(
        F.col("id").alias("vehicle_id"), F.lit("available").alias("status"), F.lit("u4pruydqqvj8").alias("geo_hash"),
        *[F.lit(None).cast("string").alias(c) for c in ("qr_code", "battery_percentage", "model", "operator_name", "base_price", "price_per_minute")],
    )
    asked = spark.createDataFrame([("u4pruydqqvj8", 6)] * 50, "location_hash string, prefix_length int")
    pages = telemetry.search_results(asked, vehicles, page_size=40).collect()
    assert {r.page for r in pages} == set(range(8))
    ids = [c["id"] for r in pages for c in json.loads(r.search_results)]
    assert sorted(ids) == list(range(300)) and all(r.vehicles_found == 300 for r in pages)
    assert geo.FULL_LENGTH == 12
