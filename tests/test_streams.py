"""Real streams over landed files: late rows, waiting, state across micro-batches."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

from ridewright.operators import intervals
from ridewright.operators import lifecycle as machine
from ridewright.sources.streams import landed_rows
from ridewright.streaming import lifecycle, settlement, waiting
from ridewright.streaming.run import drain, start_batches

START = datetime(2024, 1, 1)


def landed(spark, folder, schema, *batches):
    """One file per batch, read back one file per micro-batch in order."""
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        import time

        time.sleep(1.1)  # file order is modification order
    return landed_rows(spark, folder, spark.read.parquet(folder).schema)


def at(**delta):
    return START + timedelta(**delta)


def test_late_message_is_dropped(spark, folder):
    schema = "event_id int, ts timestamp, owner_id string, transaction_type string, amount decimal(18,2)"
    own = lambda i, ts, amount: (i, ts, "o", "OwnerToRider", Decimal(amount))
    stream = landed(
        spark, folder, schema,
        [own(1, at(hours=1), 5), own(2, at(hours=3), 7)],
        [own(3, at(hours=9), 1)],
        [own(7, at(hours=10), 2)],
        [own(4, at(hours=2), 100), own(5, at(hours=20), 1)],
        [own(6, at(hours=21), 1)],
    )
    out = drain(lambda ticks: settlement.transfers(stream, "10 minutes", ticks), "late").orderBy("window_start").collect()
    assert [(r.window_start, r.amount) for r in out] == [(START, 12), (at(hours=8), 3), (at(hours=20), 2)]


COMMAND = "event_id int, device_id string, command string, ts timestamp"
UPDATE = "device_id string, ts timestamp, state string"


def plain_exchange(commands, updates):
    """Answers and sends of every command, comparing it with all updates of its device."""
    answers, sent = {}, set()
    for number, device, state, when in commands:
        limit = when + timedelta(seconds=360)
        ours = [(t, s) for d, t, s in updates if d == device and s is not None]
        last = max((t for t, _ in ours if t <= when), default=None)
        if not device or (last, state) in ours:
            answers[number] = when
        else:
            answers[number] = min((t for t, s in ours if s == state and when <= t <= limit), default=None)
        for k in range(6 if device else 0):
            again = when + timedelta(seconds=60 * k)
            if k == 0 or answers[number] is None or again < answers[number]:
                sent.add((number, k, again))
    return answers, sent


def test_exchanges_do_not_depend_on_micro_batches(spark, folder):
    draw = random.Random(11)
    moment = lambda: at(seconds=draw.randrange(3000) // 5 * 5, milliseconds=draw.choice([0, 0, 0, 400]))
    commands = [(i, draw.choice(["a", "a", "b", ""]), draw.choice(["locked", "unlocked"]), moment()) for i in range(60)]
    updates = [(draw.choice("aab"), moment(), draw.choice(["locked", "unlocked", "moving", None])) for _ in range(120)]
    # a tie of two states, a sighting before and one in the last millisecond of the limit
    commands += [(90, "t", "locked", at(seconds=10)), (91, "u", "locked", at(seconds=10)), (92, "v", "locked", at(seconds=10, microseconds=1))]
    updates += [("t", at(seconds=9), "unlocked"), ("t", at(seconds=9), "locked"), ("u", at(seconds=370), "locked"), ("v", at(seconds=370), "moving"), ("v", at(seconds=370, microseconds=1), "locked")]
    answers, sent = plain_exchange(commands, updates)
    assert answers[90] == at(seconds=10) and answers[91] == at(seconds=370) and answers[92] == at(seconds=370, microseconds=1)

    batch = intervals.acknowledged(spark.createDataFrame(commands, COMMAND), spark.createDataFrame(updates, UPDATE))
    assert {r.event_id: r.ack_ts for r in batch.collect()} == answers
    assert {(r.event_id, r.attempt, r.sent_at) for r in intervals.sends(batch).collect()} == sent

    # within the delay, rows may come in any order
    by_time = sorted(commands, key=lambda c: c[3]), sorted(updates, key=lambda u: u[1])
    half = lambda rows: (rows[: len(rows) // 2][::-1], rows[len(rows) // 2 :])
    asked = landed(spark, f"{folder}/c", COMMAND, *half(by_time[0]))
    told = landed(spark, f"{folder}/u", UPDATE, *half(by_time[1]))
    out = drain(lambda ticks: waiting.exchanges(asked, told, delay="2 minutes", ticks=ticks), "exchanges").collect()
    assert {r.event_id: r.moment for r in out if r.kind == "answer"} == answers
    assert sum(r.kind == "answer" for r in out) == len(commands)
    assert {(r.event_id, r.attempt, r.moment) for r in out if r.kind == "send"} == sent
    assert sum(r.kind == "send" for r in out) == len(sent)


def test_choices_on_either_side_of_the_end(spark, folder):
    rides = [(r, at(seconds=1000)) for r in "abcdefg"]
    chosen = [
        ("a", at(seconds=1400), True), ("b", at(seconds=1401), True), ("c", at(seconds=1399), False), ("c", at(seconds=1400), True),
        ("d", at(seconds=10), True), ("e", at(seconds=10), None), ("e", at(seconds=1001), True), ("f", at(seconds=1000), True), ("x", at(seconds=5), True),
    ]
    given = "ride_id string, ts timestamp, by_token boolean"
    ended = landed(spark, f"{folder}/e", "ride_id string, end_time timestamp", rides[:5], rides[5:])
    choices = landed(spark, f"{folder}/c", given, chosen[4:], chosen[:4])
    out = drain(lambda ticks: waiting.payment_choices(ended, choices, delay="1 hour", ticks=ticks), "choices").collect()
    expected = {"a": True, "b": False, "c": False, "d": True, "e": True, "f": True, "g": False}
    assert {r.ride_id: r.by_token for r in out} == expected and len(out) == len(rides)
    batch = intervals.payment_choices(
        spark.createDataFrame(rides, "ride_id string, end_time timestamp"), spark.createDataFrame(chosen, given)
    )
    assert {r.ride_id: r.by_token for r in batch.collect()} == expected


def test_state_lasts_between_batches(spark, folder):
    schema = "vehicle_id bigint, event_id bigint, ts timestamp, flow string, kind string"
    batches = [
        [(1, 2, at(seconds=2), "unlock", "request"), (1, 1, at(seconds=1), "unlock", "request")],
        [(1, 3, at(seconds=3), "unlock", "success"), (2, 4, at(seconds=4), "cordon", "request")],
        [(1, 5, at(seconds=5), "lock", "request"), (1, 6, at(seconds=6), "lock", "failure")],
    ]
    vehicles = spark.createDataFrame([(1, "available"), (2, "maintenance")], "vehicle_id bigint, status string")
    stream = landed(spark, folder, schema, *batches)
    live = drain(lambda ticks: lifecycle.replay_stream(stream, vehicles), "machine").orderBy("event_id").collect()
    replayed = machine.replay(spark.createDataFrame([r for b in batches for r in b], schema), vehicles)
    assert [r.asDict() for r in live] == [r.asDict() for r in replayed.orderBy("event_id").collect()]
    assert [r.accepted for r in live] == [True, False, True, False, True, True]


def test_batches_reach_the_handler_in_order(spark, folder):
    seen = []
    stream = landed(spark, f"{folder}/in", "id int", [(1,)], [(2,), (3,)])
    start_batches(stream, lambda df, n: seen.append((n, df.count())), f"{folder}/checkpoint").awaitTermination()
    assert seen == [(0, 1), (1, 2)]
