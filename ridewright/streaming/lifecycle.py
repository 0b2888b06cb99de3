"""Vehicle state machine on a stream: one keyed state per vehicle, one writer per key."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ridewright.operators import lifecycle
from ridewright.streaming.run import use_rocksdb

OUT_SCHEMA = (
    "vehicle_id bigint, event_id bigint, ts timestamp, code int, state_before int, state_after int"
)


class VehicleMachine(StatefulProcessor):
    """Applies the events of a micro-batch in event order to the vehicle's stored state.

    A vehicle without a state begins with the ``start_state`` of its first row. The rows of one call are bounded by
    the source's rows per trigger. Events of an earlier time that arrive in a later micro-batch are applied when
    they arrive.
    """

    def __init__(self, maps: list[list[int]]):
        self._maps = maps

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("state", "state int")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        events = sorted(rows, key=lambda r: (r.ts, r.event_id))
        stored = self._state.get()
        state = stored[0] if stored else events[0].start_state
        for event in events:
            before, state = state, self._maps[event.code][state]
            yield Row(
                vehicle_id=event.vehicle_id, event_id=event.event_id, ts=event.ts, code=event.code,
                state_before=before, state_after=state,
            )
        self._state.update((state,))

    def close(self) -> None:
        pass


def replay_stream(events: DataFrame, vehicles: DataFrame) -> DataFrame:
    """What each event did, with the state kept across micro-batches.

    ``events`` as in the batch replay; ``vehicles`` (vehicle_id, status) starts the states of known
    vehicles, others start as available. The start travels on the events, so the state holds only vehicles that
    have events, however many others there are.
    """
    use_rocksdb(events.sparkSession)
    numbered = (
        lifecycle.with_event_code(events)
        .select("vehicle_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), "code")
        .dropna()
    )
    begin = lifecycle.start_states(vehicles).dropDuplicates(["vehicle_id"])
    available = F.lit(lifecycle.state_of("available"))
    started = numbered.join(begin, "vehicle_id", "left").withColumn("start_state", F.coalesce("start_state", available))
    replayed = started.groupBy("vehicle_id").transformWithState(
        statefulProcessor=VehicleMachine(lifecycle.EVENT_MAPS),
        outputStructType=OUT_SCHEMA,
        outputMode="append",
        timeMode="none",
    )
    return lifecycle.describe(replayed)
