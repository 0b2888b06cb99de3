"""Limits of waiting: inside, exactly at, after."""

import random
from datetime import datetime, timedelta

from ridewright.operators import intervals

START = datetime(2024, 1, 1)


def at(seconds):
    return START + timedelta(seconds=seconds)


def acks(spark, commands, updates):
    c = spark.createDataFrame([(i, d, at(t), s) for i, (d, t, s) in enumerate(commands)], "event_id bigint, device_id string, ts timestamp_ntz, command string")
    u = spark.createDataFrame([(d, at(t), s) for d, t, s in updates], "device_id string, ts timestamp_ntz, state string")
    return {r.event_id: r.ack_ts for r in intervals.acknowledged(c, u).collect()}


def test_limits(spark):
    got = acks(
        spark,
        [("a", 100, "locked"), ("b", 100, "locked"), ("c", 100, "locked"), ("d", 100, "locked"), ("", 100, "locked"), ("e", 5000, "unlocked")],
        [("a", 200, "locked"), ("b", 460, "locked"), ("c", 461, "locked"), ("d", 200, "unlocked"), ("e", 1, "unlocked")],
    )
    assert got == {0: at(200), 1: at(460), 2: None, 3: None, 4: at(100), 5: at(5000)}


def test_equals_brute_force(spark):
    draw = random.Random(4)
    states = ["locked", "unlocked"]
    updates = [(draw.choice("xxxyz"), t, draw.choice(states)) for t in sorted(draw.choices(range(20000), k=500))]
    commands = [(draw.choice("xxxyz"), draw.randrange(20000), draw.choice(states)) for _ in range(400)]
    got = acks(spark, commands, updates)
    for i, (device, t, state) in enumerate(commands):
        last = max((u for d, u, _ in updates if d == device and u <= t), default=None)
        before = {s for d, u, s in updates if d == device and u == last}
        later = [u for d, u, s in updates if d == device and s == state and t <= u <= t + 360]
        want = at(t) if state in before else at(min(later)) if later else None
        assert got[i] == want


def test_payment_choice_limits(spark):
    ended = spark.createDataFrame([(r, at(1000)) for r in "abcde"], "ride_id string, end_time timestamp_ntz")
    choices = spark.createDataFrame(
        [("a", at(900), True), ("b", at(1400), True), ("c", at(1401), True), ("d", at(1010), None), ("d", at(1020), True), ("d", at(1030), False)],
        "ride_id string, ts timestamp_ntz, by_token boolean",
    )
    got = dict(intervals.payment_choices(ended, choices).select("ride_id", "by_token").collect())
    assert got == {"a": True, "b": True, "c": False, "d": True, "e": False}
