"""Vehicles in service: requests take a vehicle, its device is commanded, and its answer or a timer releases it.

One keyed state per vehicle, with event-time timers for resends and for the limit of an answer. Rows wait until
the watermark has passed them and are then taken in the order of their instants, so the status of a vehicle does
not depend on how its requests and reports fell into micro-batches or on which topic was read first.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ridewright.operators.intervals import ACK_LIMIT_SECONDS, COMMANDS, RESEND_SECONDS, SENDS, state_bits
from ridewright.operators.lifecycle import FLOWS
from ridewright.streaming.run import timed, use_rocksdb

DEFAULT_DELAY = "5 seconds"
SECOND = 1_000_000

# What a request carries along to everything that it leads to.
CARRIED = ["flow", "job_id", "rider_id", "device_id", "vendor", "details"]
REQUESTS = (
    "vehicle_id string, ts timestamp, flow string, job_id string, rider_id string, device_id string, vendor string, "
    "details string, status string, device_state string"
)
SIGHTINGS = "vehicle_id string, ts timestamp, state string"
_CARRIED = ", ".join(f"{c} string" for c in CARRIED)
EFFECTS = (
    f"vehicle_id string, {_CARRIED}, effect string, asked bigint, moment bigint, step int, attempt int, status string, in_transition boolean"
)


class FleetMachine(StatefulProcessor):
    """The status of a vehicle and the command that is under way.

    Effects: ``refused`` (not in the required status, or in transition), ``taken``, ``send``, ``success`` and
    ``failure``, each with the status after it; ``step`` orders those of one moment. A flow without a command
    succeeds at once.
    """

    def __init__(self, limit: int = ACK_LIMIT_SECONDS):
        self._limit = limit * SECOND

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        row = f"at bigint, {_CARRIED}, bits int, status string, known int"
        self._early = handle.getListState("early", row)
        self._state = handle.getValueState("state", "status string, bits int")
        self._open = handle.getValueState("open", f"at bigint, {_CARRIED}, bits int, attempt int")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        came = [(r.at, *(r[c] for c in CARRIED), r.bits, r.status, r.known) for r in rows]
        self._early.appendList(came)
        self._handle.registerTimer(-(-min(r[0] for r in came) // 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        early = list(self._early.get())
        # of one instant, reports go before requests
        ready = sorted((r for r in early if r[0] <= now), key=lambda r: (r[0], r[1] is not None, r[2] or "", r[1] or ""))
        rest = [r for r in early if r[0] > now]
        status, known = self._state.get() if self._state.exists() else (None, None)
        under_way = list(self._open.get()) if self._open.exists() else None
        n = len(CARRIED)
        out: list[Row] = []

        def tell(command, effect: str, moment: int, attempt: int | None = None) -> None:
            out.append(
                Row(
                    vehicle_id=key[0],
                    **dict(zip(CARRIED, command[1 : n + 1], strict=True)),
                    effect=effect,
                    asked=command[0],
                    moment=moment,
                    step=len(out),
                    attempt=attempt,
                    status=status,
                    in_transition=under_way is not None,
                )
            )

        def send(before: int) -> None:
            while under_way[-1] < SENDS and under_way[0] + under_way[-1] * RESEND_SECONDS * SECOND < before:
                tell(under_way, "send", under_way[0] + under_way[-1] * RESEND_SECONDS * SECOND, under_way[-1])
                under_way[-1] += 1

        def end(effect: str, moment: int) -> None:
            nonlocal status, under_way
            command, under_way = under_way, None
            flow = FLOWS[command[1]]
            status = flow.on_success if effect == "success" else flow.on_failure or flow.required
            tell(command, effect, moment)

        def limit_before(instant: int) -> None:
            """Fail the command under way if its limit lies before an instant."""
            if under_way is not None and under_way[0] + self._limit < instant:
                send(under_way[0] + self._limit + 1)
                end("failure", under_way[0] + self._limit)

        for row in ready:
            at, flow = row[0], row[1]
            limit_before(at)
            if flow is None:
                bits = row[n + 1]
                # reports of one instant hold together
                known = bits | (known or 0) if self._last_report == at else bits
                self._last_report = at
                if under_way is not None and under_way[n + 1] & known:
                    send(at)
                    end("success", at)
                continue
            if status is None:
                status = row[n + 2]
            if known is None:
                known = row[n + 3]
            if flow not in FLOWS or status != FLOWS[flow].required or under_way is not None:
                tell(row, "refused", at)
                continue
            command = FLOWS[flow].command
            under_way = [*row[: n + 1], 0 if command is None else 1 << COMMANDS.index(command), 0]
            tell(row, "taken", at)
            if command is not None and under_way[4]:
                send(at + 1)
                if under_way[n + 1] & (known or 0):
                    end("success", at)
            else:  # no command, or no device to command
                end("success", at)
        if under_way is not None:
            send(now + 1)
            limit_before(now + 1)
        self._last_report = None
        self._early.put(rest) if rest else self._early.clear()
        self._state.update((status, known))
        self._open.update(tuple(under_way)) if under_way is not None else self._open.clear()
        times = [r[0] for r in rest]
        if under_way is not None:
            times.append(under_way[0] + self._limit + 1)
            if under_way[-1] < SENDS:
                times.append(under_way[0] + under_way[-1] * RESEND_SECONDS * SECOND)
        if times:
            self._handle.registerTimer(-(-min(times) // 1000))
        yield from out

    _last_report: int | None = None

    def close(self) -> None:
        pass


def effects(
    requests: DataFrame,
    sightings: DataFrame,
    limit: int = ACK_LIMIT_SECONDS,
    delay: str = DEFAULT_DELAY,
    ticks: DataFrame | None = None,
) -> DataFrame:
    """What all requests lead to, as rows of ``EFFECTS`` with ``ts`` (asked) and ``moment`` as timestamps.

    ``requests`` (``REQUESTS``) carry the status and device state that are stored for the vehicle, which only
    count for a vehicle that has no state here yet; ``sightings`` (``SIGHTINGS``) are reports of its device.
    """
    use_rocksdb(requests.sparkSession)
    at = F.unix_micros("ts").alias("at")
    none = [F.lit(None).cast("string").alias(c) for c in CARRIED]
    asked = timed(requests, "ts", delay, ticks).where("vehicle_id is not null and flow is not null")
    seen = timed(sightings, "ts", delay, ticks).where("vehicle_id is not null and state is not null")
    rows = asked.select(
        "ts", "vehicle_id", at, *CARRIED, F.lit(0).alias("bits"), "status", state_bits(F.col("device_state")).alias("known")
    ).unionByName(
        seen.select("ts", "vehicle_id", at, *none, state_bits(F.col("state")).alias("bits"), F.lit(None).cast("string").alias("status"), F.lit(0).alias("known"))
    )
    out = rows.groupBy("vehicle_id").transformWithState(
        statefulProcessor=FleetMachine(limit), outputStructType=EFFECTS, outputMode="append", timeMode="eventTime"
    )
    return out.withColumns({"ts": F.timestamp_micros("asked"), "moment": F.timestamp_micros("moment")}).drop("asked")
