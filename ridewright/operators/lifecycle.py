"""Vehicle status as a keyed state machine.

A request takes the vehicle only if it is in the flow's required status and not in transition; an
outcome sets the flow's next status and ends the transition. Every event is therefore a map from
the eight possible states to the next one, and the map of a stretch of events is the composition
of theirs. That lets a vehicle with very many events be replayed in parallel blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridewright.operators import ordered
from ridewright.session import cut_lineage

# Vehicle statuses.
STATUSES = ["available", "onmission", "notavailable", "maintenance"]


@dataclass(frozen=True)
class Flow:
    required: str
    command: str | None
    on_success: str
    on_failure: str | None
    tracks_job: bool = True


# Required status, device command, status after success and after failure.
FLOWS = {
    "unlock": Flow("available", "unlocked", "onmission", "available"),
    "lock": Flow("onmission", "locked", "available", "maintenance", tracks_job=False),
    "cordon": Flow("available", None, "notavailable", None),
    "uncordon": Flow("notavailable", None, "available", None),
    "garage": Flow("notavailable", "unlocked", "maintenance", "notavailable"),
    "ungarage": Flow("maintenance", "locked", "notavailable", "maintenance"),
    "cordon_garage": Flow("available", "unlocked", "maintenance", "available"),
    "ungarage_uncordon": Flow("maintenance", "locked", "available", "maintenance"),
}
KINDS = ["request", "success", "failure"]
STATES = 2 * len(STATUSES)
ORDER = ["ts", "event_id"]


def state_of(status: str, in_transition: bool = False) -> int:
    return 2 * STATUSES.index(status) + int(in_transition)


def _event_map(flow: Flow, kind: str) -> list[int]:
    if kind == "request":
        taken = list(range(STATES))
        taken[state_of(flow.required)] = (
            state_of(flow.required, True) if flow.command else state_of(flow.on_success)
        )
        return taken
    after = flow.on_success if kind == "success" else flow.on_failure or flow.required
    return [state_of(after)] * STATES


# Next state by event code (flow, kind) and state.
EVENT_MAPS = [_event_map(flow, kind) for flow in FLOWS.values() for kind in KINDS]


def with_event_code(events: DataFrame) -> DataFrame:
    """Number the (flow, kind) pair; unknown pairs get null and are dropped by the replay."""
    codes = {
        f"{flow}/{kind}": len(KINDS) * i + k
        for i, flow in enumerate(FLOWS)
        for k, kind in enumerate(KINDS)
    }
    pair = F.concat_ws("/", "flow", "kind")
    table = F.create_map(*[F.lit(x) for item in codes.items() for x in item])
    return events.withColumn("code", F.try_element_at(table, pair))


def start_states(vehicles: DataFrame) -> DataFrame:
    """(vehicle_id, start_state) of vehicles with a known status, none in transition."""
    status = F.array_position(F.array(*[F.lit(s) for s in STATUSES]), F.col("status")) - 1
    begin = vehicles.select("vehicle_id", (status * 2).cast("int").alias("start_state"))
    return begin.where("start_state >= 0")


def _replay(events: DataFrame, keys: list[str]) -> DataFrame:
    """State before and after each event, from ``start_state`` at the first row of a key."""
    maps = EVENT_MAPS

    def advance(state, first, column):
        before, after = [], []
        for new_key, start, code in zip(first, column("start_state").to_pylist(), column("code").to_pylist()):
            if new_key:
                state = start
            before.append(state)
            state = maps[code][state]
            after.append(state)
        return state, [pa.array(before, pa.int32()), pa.array(after, pa.int32())]

    return ordered.stream_rows(
        ordered.hashed_and_sorted(events, keys, ORDER),
        keys,
        advance,
        {"state_before": "int", "state_after": "int"},
        ["vehicle_id", "event_id", "ts", "code"],
    )


def _block_starts(blocks: DataFrame) -> DataFrame:
    """State at the start of every block, from the composed maps of the blocks before it."""
    maps, states = np.array(EVENT_MAPS), STATES
    keys = ["vehicle_id", "block"]

    def compose(carry, batch):
        start, moves = carry or (batch.column("start_state")[0].as_py(), np.arange(states))
        for code in batch.column("code").to_pylist():
            moves = maps[code][moves]
        return start, moves

    narrow = ordered.hashed_and_sorted(
        blocks.select(*keys, "start_state", "code", *ORDER), keys, ORDER
    )
    composed = ordered.stream_summaries(
        narrow, keys, compose, {"start_state": "int", "moves": "array<int>"}
    )

    def advance(state, first, column):
        starts = []
        for new_key, start, moves in zip(first, column("start_state").to_pylist(), column("moves").to_pylist()):
            state = start if new_key else state
            starts.append(state)
            state = moves[state]
        return state, [pa.array(starts, pa.int32())]

    return cut_lineage(
        ordered.stream_rows(
            ordered.hashed_and_sorted(composed, ["vehicle_id"], ["block"]),
            ["vehicle_id"],
            advance,
            {"state": "int"},
            ["vehicle_id", "block"],
        )
    ).withColumnRenamed("state", "start_state")


def replay(
    events: DataFrame,
    vehicles: DataFrame,
    *,
    max_rows: int = ordered.MAX_ROWS_PER_KEY,
    block_rows: int = ordered.BLOCK_ROWS,
) -> DataFrame:
    """All events of known vehicles, in event order, with what they did.

    ``events``: vehicle_id, event_id, ts, flow, kind (request, success, failure). ``vehicles``:
    vehicle_id, status.
    """
    numbered = with_event_code(events).select("vehicle_id", "event_id", "ts", "code").dropna()
    known = numbered.join(start_states(vehicles), "vehicle_id")
    plain, hot, hot_rows = ordered.split_hot(known, "vehicle_id", max_rows)
    done = _replay(plain, ["vehicle_id"])
    if hot is not None:
        blocks = ordered.cut_into_blocks(hot, "vehicle_id", ORDER, hot_rows, block_rows)
        starts = _block_starts(blocks)
        again = blocks.drop("start_state").join(starts, ["vehicle_id", "block"])
        done = done.unionByName(_replay(again, ["vehicle_id", "block"]))
    return describe(done)


def describe(replayed: DataFrame) -> DataFrame:
    """Readable columns and the side effects of each event."""
    names = F.array(*[F.lit(s) for s in STATUSES])
    flow_no = (F.col("code") / len(KINDS)).cast("int")
    kind_no = F.col("code") % len(KINDS)

    def by_flow(values: list) -> Column:
        return F.array(*[F.lit(v) for v in values])[flow_no]

    def status(column: str) -> Column:
        return names[(F.col(column) / 2).cast("int")]

    flow = by_flow(list(FLOWS))
    kind = F.array(*[F.lit(k) for k in KINDS])[kind_no]
    accepted = (kind != "request") | (F.col("state_before") != F.col("state_after"))
    tracked = by_flow([f.tracks_job for f in FLOWS.values()])
    failed = (kind == "failure") | ~accepted
    return replayed.select(
        "vehicle_id",
        "event_id",
        "ts",
        flow.alias("flow"),
        kind.alias("kind"),
        status("state_before").alias("status_before"),
        accepted.alias("accepted"),
        status("state_after").alias("status_after"),
        (F.col("state_after") % 2 == 1).alias("in_transition"),
        F.when(tracked & failed, F.lit("failed"))
        .when(tracked & (kind == "request"), F.lit("started"))
        .alias("job_state"),
        F.when((kind == "request") & accepted, by_flow([f.command for f in FLOWS.values()])).alias(
            "command"
        ),
        ((flow == "lock") & (kind == "failure")).alias("lock_failed"),
    )


def plain_status(vehicles: DataFrame, statuses: DataFrame) -> DataFrame:
    """Unconditional status change: the last given status per vehicle."""
    last = statuses.groupBy("vehicle_id").agg(
        F.max_by("status", F.struct("ts", "event_id")).alias("_status")
    )
    return (
        vehicles.join(last, "vehicle_id", "left")
        .withColumn("status", F.coalesce("_status", "status"))
        .drop("_status")
    )
