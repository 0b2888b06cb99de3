"""The status machine: competing requests, failures, and block replay."""

import random
from datetime import datetime, timedelta

from ridewright.operators import lifecycle

START = datetime(2024, 1, 1)
EVENT = "vehicle_id bigint, event_id bigint, ts timestamp_ntz, flow string, kind string"


def events(spark, rows):
    timed = [(v, i, START + timedelta(seconds=i), f, k) for i, (v, f, k) in enumerate(rows)]
    random.Random(2).shuffle(timed)
    return spark.createDataFrame(timed, EVENT)


def vehicles(spark, statuses):
    return spark.createDataFrame(list(statuses.items()), "vehicle_id bigint, status string")


def replayed(spark, rows, statuses, **limits):
    done = lifecycle.replay(events(spark, rows), vehicles(spark, statuses), **limits)
    return [r.asDict() for r in done.orderBy("event_id").collect()]


def test_second_request_loses(spark):
    out = replayed(
        spark,
        [(1, "unlock", "request"), (1, "unlock", "request"), (1, "unlock", "success"), (1, "lock", "request"), (1, "lock", "failure")],
        {1: "available"},
    )
    assert [r["accepted"] for r in out] == [True, False, True, True, True]
    assert [r["job_state"] for r in out] == ["started", "failed", None, None, None]
    assert [r["command"] for r in out] == ["unlocked", None, None, "locked", None]
    assert out[2]["status_after"] == "onmission" and not out[2]["in_transition"]
    assert out[4]["status_after"] == "maintenance" and out[4]["lock_failed"]


def test_wrong_status_and_failed_command(spark):
    out = replayed(
        spark,
        [(1, "ungarage", "request"), (1, "cordon_garage", "request"), (1, "cordon_garage", "failure"), (1, "cordon", "request"), (1, "uncordon", "request")],
        {1: "available"},
    )
    assert [r["accepted"] for r in out] == [False, True, True, True, True]
    assert [r["status_after"] for r in out] == ["available"] * 3 + ["notavailable", "available"]
    assert out[2]["job_state"] == "failed" and out[3]["in_transition"] is False


def test_blocks_equal_plain_replay(spark):
    draw = random.Random(5)
    flows, kinds = list(lifecycle.FLOWS), lifecycle.KINDS
    rows = [(draw.choice([1, 1, 1, 2, 3]), draw.choice(flows), draw.choice(["request", "request", *kinds])) for _ in range(3000)]
    statuses = {1: "available", 2: "maintenance", 3: "onmission"}
    plain = replayed(spark, rows, statuses)
    assert plain == replayed(spark, rows, statuses, max_rows=100, block_rows=130)
    assert len(plain) == 3000


def test_unknown_flow_is_dropped(spark):
    assert replayed(spark, [(1, "paint", "request")], {1: "available"}) == []


def test_plain_status_takes_the_last(spark):
    changes = spark.createDataFrame(
        [(1, 1, START, "maintenance"), (1, 2, START + timedelta(seconds=1), "notavailable")],
        "vehicle_id bigint, event_id bigint, ts timestamp_ntz, status string",
    )
    out = lifecycle.plain_status(vehicles(spark, {1: "available", 2: "onmission"}), changes)
    assert dict(out.select("vehicle_id", "status").collect()) == {1: "notavailable", 2: "onmission"}
