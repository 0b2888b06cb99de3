"""Waiting for acknowledgements and payment choices: keyed state with event-time timers instead of polling.

Rows of a key are kept until the watermark has passed them and are then taken in the order of their instants,
so the result does not depend on how they fell into micro-batches, and equals that of the batch operators.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ridewright.operators.intervals import (
    ACK_LIMIT_SECONDS,
    CHOICE_LIMIT_SECONDS,
    RESEND_SECONDS,
    SENDS,
    state_bits,
)
from ridewright.streaming.run import timed, use_rocksdb

DEFAULT_DELAY = "1 minute"
CHOICE_KEPT_SECONDS = 7 * 86_400
SECOND = 1_000_000


def _wake(handle: StatefulProcessorHandle, instants: list[int]) -> None:
    """A timer for the earliest of these microseconds."""
    if instants:
        handle.registerTimer(-(-min(instants) // 1000))


class CommandMachine(StatefulProcessor):
    """Commands of a device, sent again each minute until the device reports the commanded state.

    Puts out a row for every send and one for the answer, which is null after the limit.
    """

    def __init__(self, event_id: T.DataType, limit: int):
        self._limit = limit * SECOND
        self._row = T.StructType(
            [T.StructField("at", T.LongType()), T.StructField("event_id", event_id), T.StructField("command", T.StringType()), T.StructField("bits", T.IntegerType())]
        )
        self._waiting = T.StructType([*self._row.fields, T.StructField("attempt", T.IntegerType())])
        self.schema = T.StructType(
            [
                T.StructField("device_id", T.StringType()),
                T.StructField("event_id", event_id),
                T.StructField("command", T.StringType()),
                T.StructField("at", T.LongType()),
                T.StructField("kind", T.StringType()),
                T.StructField("attempt", T.IntegerType()),
                T.StructField("moment", T.LongType()),
            ]
        )

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._early = handle.getListState("early", self._row)
        self._open = handle.getListState("open", self._waiting)
        self._known = handle.getValueState("known", "bits int")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        came = [(r.at, r.event_id, r.command, r.bits) for r in rows]
        self._early.appendList(came)
        _wake(self._handle, [at for at, *_ in came])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        early = sorted(self._early.get(), key=lambda r: r[0])
        ready, rest = [r for r in early if r[0] <= now], [r for r in early if r[0] > now]
        waiting = [list(r) for r in self._open.get()]
        known = self._known.get()[0] if self._known.exists() else 0
        out: list[Row] = []

        def tell(command: list, kind: str, attempt: int | None, moment: int | None) -> None:
            out.append(Row(device_id=key[0], event_id=command[1], command=command[2], at=command[0], kind=kind, attempt=attempt, moment=moment))

        def send(command: list, before: int) -> None:
            """The sends that fall before an instant."""
            while command[4] < SENDS and command[0] + command[4] * RESEND_SECONDS * SECOND < before:
                tell(command, "send", command[4], command[0] + command[4] * RESEND_SECONDS * SECOND)
                command[4] += 1

        i = 0
        while i < len(ready):
            at, j = ready[i][0], i
            while j < len(ready) and ready[j][0] == at:
                j += 1
            seen = [r for r in ready[i:j] if r[2] is None]
            if seen:
                known = 0
                for r in seen:
                    known |= r[3]
                left = []
                for command in waiting:
                    if command[3] & known and at <= command[0] + self._limit:
                        send(command, at)
                        tell(command, "answer", None, at)
                    else:
                        left.append(command)
                waiting = left
            for r in ready[i:j]:
                if r[2] is not None:
                    command = [*r, 0]
                    send(command, at + 1)
                    if r[3] & known:
                        tell(command, "answer", None, at)
                    else:
                        waiting.append(command)
            i = j
        left = []
        for command in waiting:
            send(command, now + 1)
            if command[0] + self._limit <= now:
                tell(command, "answer", None, None)
            else:
                left.append(command)
        if ready:
            self._known.update((known,))
            self._early.put(rest) if rest else self._early.clear()
        self._open.put([tuple(c) for c in left]) if left else self._open.clear()
        times = [r[0] for r in rest] + [c[0] + self._limit for c in left]
        times += [c[0] + c[4] * RESEND_SECONDS * SECOND for c in left if c[4] < SENDS]
        _wake(self._handle, times)
        yield from out

    def close(self) -> None:
        pass


def exchanges(
    commands: DataFrame,
    updates: DataFrame,
    limit: int = ACK_LIMIT_SECONDS,
    delay: str = DEFAULT_DELAY,
    ticks: DataFrame | None = None,
) -> DataFrame:
    """(event_id, device_id, command, ts, kind, attempt, moment): every send and the answer of every command.

    ``commands``: event_id, device_id, command, ts; ``updates``: device_id, ts, state. An answer comes when the
    watermark has passed it, with a null moment if none came in time. A command without a device is answered at
    once and never sent.
    """
    use_rocksdb(commands.sparkSession)
    micros = F.unix_micros("ts").alias("at")
    asked = timed(commands, "ts", delay, ticks)
    seen = timed(updates.select("device_id", "ts", "state"), "ts", delay, ticks)
    sent = asked.where(F.col("device_id") != "").select("ts", "device_id", micros, "event_id", "command", state_bits(F.col("command")).alias("bits"))
    told = seen.where((F.col("device_id") != "") & F.col("state").isNotNull()).select(
        "ts", "device_id", micros, F.lit(None).cast(commands.schema["event_id"].dataType).alias("event_id"), F.lit(None).cast("string").alias("command"), state_bits(F.col("state")).alias("bits")
    )
    machine = CommandMachine(commands.schema["event_id"].dataType, limit)
    answered = sent.unionByName(told).groupBy("device_id").transformWithState(
        statefulProcessor=machine, outputStructType=machine.schema, outputMode="append", timeMode="eventTime"
    )
    instant = lambda c: F.timestamp_micros(c)
    columns = ["event_id", "device_id", "command"]
    live = answered.select(*columns, instant("at").alias("ts"), "kind", "attempt", instant("moment").alias("moment"))
    at_once = asked.where(F.col("device_id") == "").select(
        *columns, F.col("ts").cast("timestamp").alias("ts"), F.lit("answer").alias("kind"), F.lit(None).cast("int").alias("attempt"), F.col("ts").cast("timestamp").alias("moment")
    )
    return live.unionByName(at_once)


def acknowledgements(commands: DataFrame, updates: DataFrame, **how) -> DataFrame:
    """(event_id, device_id, command, ts, ack_ts): when each command's state was first seen, null if not in time."""
    answers = exchanges(commands, updates, **how).where("kind = 'answer'")
    return answers.select("event_id", "device_id", "command", "ts", F.col("moment").alias("ack_ts"))


def sends(commands: DataFrame, updates: DataFrame, **how) -> DataFrame:
    """(event_id, device_id, command, attempt, sent_at): every time a command goes out."""
    out = exchanges(commands, updates, **how).where("kind = 'send'")
    return out.select("event_id", "device_id", "command", "attempt", F.col("moment").alias("sent_at"))


class ChoiceMachine(StatefulProcessor):
    """The first payment choice of a ride, whichever of the two comes first."""

    def __init__(self, ride_id: T.DataType, limit: int, kept: int):
        self._limit, self._kept = limit * SECOND, kept * SECOND
        self.schema = T.StructType(
            [T.StructField("ride_id", ride_id), T.StructField("ended", T.LongType()), T.StructField("by_token", T.BooleanType())]
        )

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._ends = handle.getListState("ends", "ended bigint")
        self._choice = handle.getValueState("choice", "at bigint, by_token boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        came = list(rows)
        ends = [r.at for r in came if r.by_token is None]
        choices = [(r.at, r.by_token) for r in came if r.by_token is not None]
        if ends:
            self._ends.appendList([(e,) for e in ends])
        if self._choice.exists():
            choices.append(tuple(self._choice.get()))
        if choices:
            self._choice.update(min(choices))
        # a choice is settled once nothing earlier can come
        times = [e + self._limit for e in ends] + [at for at, _ in choices]
        _wake(self._handle, times)
        if choices:
            _wake(self._handle, [min(choices)[0] + self._kept])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        at, by_token = self._choice.get() if self._choice.exists() else (None, False)
        settled = at is not None and at <= now
        left = []
        for (end,) in self._ends.get():
            if settled or end + self._limit <= now:
                yield Row(ride_id=key[0], ended=end, by_token=bool(settled and at <= end + self._limit and by_token))
            else:
                left.append((end,))
        self._ends.put(left) if left else self._ends.clear()
        _wake(self._handle, [end + self._limit for (end,) in left])
        if at is not None and not left and at + self._kept <= now:
            self._choice.clear()

    def close(self) -> None:
        pass


def payment_choices(
    ended: DataFrame,
    choices: DataFrame,
    limit: int = CHOICE_LIMIT_SECONDS,
    delay: str = DEFAULT_DELAY,
    ticks: DataFrame | None = None,
    kept: int = CHOICE_KEPT_SECONDS,
) -> DataFrame:
    """(ride_id, end_time, by_token): the first choice, stored before the end or within ``limit`` seconds of it.

    ``ended``: ride_id, end_time; ``choices``: ride_id, ts, by_token. A ride is told as soon as its choice is
    settled, as not paid in tokens once the limit has passed. Choices without a ride go after ``kept`` seconds.
    """
    use_rocksdb(ended.sparkSession)
    rides = timed(ended.withColumnRenamed("end_time", "ts"), "ts", delay, ticks)
    given = timed(choices.select("ride_id", "ts", "by_token"), "ts", delay, ticks)
    micros = F.unix_micros("ts").alias("at")
    left = rides.where("ride_id is not null").select("ts", "ride_id", micros, F.lit(None).cast("boolean").alias("by_token"))
    right = given.where("ride_id is not null and by_token is not null").select("ts", "ride_id", micros, "by_token")
    machine = ChoiceMachine(ended.schema["ride_id"].dataType, limit, kept)
    out = left.unionByName(right).groupBy("ride_id").transformWithState(
        statefulProcessor=machine, outputStructType=machine.schema, outputMode="append", timeMode="eventTime"
    )
    return out.select("ride_id", F.timestamp_micros("ended").alias("end_time"), "by_token")
