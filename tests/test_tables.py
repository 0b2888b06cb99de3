"""Keyed table writes, expiry, ledgers, routing and the gate."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ridewright.operators import routing, settlement
from ridewright.operators.lookup import lookup
from ridewright.sinks import export, tables, topics
from ridewright.sinks.files import Folder
from ridewright.sources import streams
from ridewright.sources import tables as source
from ridewright.schemas import MESSAGES

NOON = datetime(2024, 5, 1, 12)
DAYS = [date(2024, 5, d) for d in (1, 2, 3)]


def test_dated_scan_reads_only_its_folders(spark, folder):
    path = f"{folder}/t"
    rows = spark.createDataFrame([(i, DAYS[i]) for i in range(3)], "id int, effective_date date")
    rows.write.partitionBy("effective_date").parquet(path)
    scan = source.on_dates(source.table(spark, path), [DAYS[1]])
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(effective_date" in plan
    assert [r.id for r in scan.collect()] == [1]


def test_expiring_rows_keep_the_disk_flat(spark, folder):
    path, sizes = f"{folder}/x", []
    for batch in range(6):  # a batch each half hour, its rows live five minutes
        at = NOON + timedelta(minutes=30 * batch)
        rows = spark.createDataFrame([(i, at) for i in range(50)], "id int, at timestamp")
        for _ in range(2):  # a repeated batch replaces its own
            tables.write_expiring(rows, path, "at", 300, "job", batch)
        tables.remove_expired(spark, path, at)
        sizes.append(Folder(spark, path).size(""))
        alive = tables.live(spark, path, F.lit(at + timedelta(seconds=299)), "id int, at timestamp")
        assert alive.count() == 50
        assert tables.live(spark, path, F.lit(at + timedelta(seconds=300)), "id int, at timestamp").count() == 0
        assert "PartitionFilters: [isnotnull(until" in alive._jdf.queryExecution().executedPlan().toString()
    assert max(sizes[1:]) <= 3 * sizes[0]
    assert tables.live(spark, f"{folder}/none", F.lit(NOON), "id int").count() == 0


def test_ledger_batches_are_idempotent(spark, folder):
    entry = spark.createDataFrame([("o", Decimal("1.239")), ("o", Decimal("-0.509"))], "owner_id string, amount decimal(10,3)")
    for _ in range(2):
        tables.append_ledger(entry, f"{folder}/l", 0)
    tables.append_ledger(entry, f"{folder}/l", 1)
    assert tables.counter(spark, f"{folder}/l", "owner_id", "amount").first().delta_cents == 2 * (123 - 50)


def test_repeated_dimension_keys_do_not_multiply(spark):
    left = spark.createDataFrame([(1,)] * 5 + [(2,)], "k int")
    dim = spark.createDataFrame([(1, "b"), (1, "a")] * 20, "k int, v string")
    got = lookup(left, dim, ["k"], take=["v"], keep_misses=True, defaults={"v": F.lit("-")}, first_by=["v"])
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a")] * 5 + [(2, "-")]


def test_export_hides_keys_and_cuts(spark):
    df = spark.sql(
        "select timestamp_ntz '2024-05-01 13:00:01' t, date '2024-05-01' d, cast(-1.23456789019 as decimal(20,11)) x, 'k' private_key, cast('b' as binary) wallet"
    )
    assert export.export_rows(df).first().asDict() == {"t": "2024-05-01 13:00:01", "d": "2024-05-01", "x": Decimal("-1.234567890")}


def test_commands_go_to_the_vendor_topic(spark):
    df = spark.createDataFrame([("dev", "acme", "locked"), ("dev", None, "locked")], "device_id string, vendor string, command string")
    first = topics.device_commands(df).first()
    assert tuple(first) == ("iot-commands-acme", '{"deviceId":"dev","vendor":"acme","command":"locked"}')


def test_decoding(spark):
    df = spark.createDataFrame([('{"riderId":"r","unknown":1}',), ('{"riderId":',), ("",), (None,)], "body string")
    parsed = streams.decode(df, "body", MESSAGES["end-ride"])
    assert [r.riderId for r in streams.good(parsed).collect()] == ["r"]
    assert streams.dead_letters(parsed, "body").count() == 3
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        streams.decode(df, "body", MESSAGES["end-ride"], on_error="fail").collect()


def test_payable_bounds_are_inclusive(spark):
    since, until = routing.look_back(NOON, 600_000)
    assert until - since == timedelta(minutes=15)
    moments = [since, until, since - timedelta(seconds=1), until + timedelta(seconds=1), None]
    df = spark.createDataFrame(
        [(i, m, None, True) for i, m in enumerate(moments)] + [(9, until, "c", True), (10, until, None, None)],
        "ride_id int, end_time timestamp_ntz, capture_transaction_id string, paid_with_token boolean",
    )
    assert sorted(r.ride_id for r in routing.payable_rides(df, since, until).collect()) == [0, 1]


TRANSFER = "event_id int, ts timestamp_ntz, owner_id string, transaction_type string, amount decimal(18,2)"


def test_netting_suppresses_zero(spark):
    data = [(1, NOON, "a", "OwnerToRider", Decimal(5)), (2, NOON, "a", "RiderToOwner", Decimal(5)), (3, NOON, "b", "RiderToOwner", Decimal(2)), (4, NOON + timedelta(hours=4), "a", "OwnerToRider", Decimal(1))]
    net = settlement.owner_netting(spark.createDataFrame(data, TRANSFER)).orderBy("window_start", "owner_id").collect()
    assert [(r.window_start.hour, r.owner_id, r.transaction_type, r.amount) for r in net] == [(12, "b", "RiderToOwner", 2), (16, "a", "OwnerToRider", 1)]


def test_gate_releases_one_per_sender(spark):
    waiting = spark.createDataFrame([(i, s, NOON + timedelta(seconds=i)) for i, s in enumerate(["op", "op", "w1", "w2", "w2", None])], "event_id int, from_address string, ts timestamp_ntz")
    pending = spark.createDataFrame([("w2",), ("w2",)], "from_address string")
    got = {r.event_id: r.gate for r in settlement.pending_gate(waiting, pending, ["ts", "event_id"]).collect()}
    assert got == {0: "release", 1: "defer", 2: "release", 3: "defer", 4: "defer", 5: "defer"}
