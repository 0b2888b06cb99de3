"""Vehicles in service: random requests and reports against a plain model, however they fall into micro-batches."""

import random
from datetime import datetime, timedelta

from ridewright.operators.lifecycle import FLOWS, STATUSES
from ridewright.sources.streams import landed_rows
from ridewright.streaming import fleet
from ridewright.streaming.run import drain

START = datetime(2024, 1, 1)


def at(seconds):
    return START + timedelta(seconds=seconds)


def plain(requests, sightings):
    """One vehicle after the other, one instant after the other."""
    out = []
    for vehicle in sorted({r["vehicle_id"] for r in requests}):
        asked = sorted((r for r in requests if r["vehicle_id"] == vehicle), key=lambda r: (r["ts"], r["job_id"], r["flow"]))
        seen = sorted((t, s) for v, t, s in sightings if v == vehicle)
        status, free_from, state = asked[0]["status"], START, None
        for r in asked:
            t, flow = r["ts"], FLOWS[r["flow"]]
            state = status  # as of the last end
            if t < free_from or (t == free_from and not done_before_requests) or state != flow.required:
                out.append((r["job_id"], "refused", t))
                continue
            out.append((r["job_id"], "taken", t))
            end, good = t, True
            if flow.command and r["device_id"]:
                last = max((u for u, _ in seen if u <= t), default=None)
                known = {s for u, s in seen if u == last} if last else {r["device_state"]}
                later = [u for u, s in seen if s == flow.command and t <= u <= t + timedelta(seconds=360)]
                good = flow.command in known or bool(later)
                end = t if flow.command in known else min(later, default=t + timedelta(seconds=360))
                sent = [t + timedelta(seconds=60 * k) for k in range(6)]
                out += [(r["job_id"], "send", u) for u in sent if u == t or u < end or not good]
            out.append((r["job_id"], "success" if good else "failure", end))
            status = flow.on_success if good else flow.on_failure or flow.required
            # reports and ends come before the requests of an instant, a limit only after it
            free_from, done_before_requests = end, good
    return sorted(out, key=str)


def test_random_fleet(spark, folder):
    draw = random.Random(3)
    names = list(FLOWS)
    requests, sightings = [], []
    for v in range(12):
        status = draw.choice(STATUSES)
        for n in range(14):
            requests.append(
                dict(
                    vehicle_id=f"v{v}", ts=at(draw.randrange(0, 6000, 10)), flow=draw.choice(names), job_id=f"{v}-{n:02d}", rider_id="r",
                    device_id="" if v % 5 == 4 else f"d{v}", vendor="x", details=None, status=status, device_state=draw.choice(["locked", "unlocked", None]) if n == 0 else None,
                )
            )
        first = min((r for r in requests if r["vehicle_id"] == f"v{v}"), key=lambda r: (r["ts"], r["job_id"]))
        known = draw.choice(["locked", "unlocked", None])
        for r in requests:
            if r["vehicle_id"] == f"v{v}":
                r["device_state"] = known
        assert first["status"] == status
        sightings += [(f"v{v}", at(draw.randrange(0, 6500, 10)), draw.choice(["locked", "unlocked", "moving"])) for _ in range(25)]
    rows = [tuple(r.values()) for r in requests]
    half = len(rows) // 2
    by_time = sorted(rows, key=lambda r: r[1])
    for name, schema, parts in (
        ("r", fleet.REQUESTS, (by_time[:half][::-1], by_time[half:])),
        ("s", fleet.SIGHTINGS, (sorted(sightings, key=lambda s: s[1]),)),
    ):
        for part in parts:
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")
    asked = landed_rows(spark, f"{folder}/r", spark.createDataFrame([], fleet.REQUESTS).schema)
    seen = landed_rows(spark, f"{folder}/s", spark.createDataFrame([], fleet.SIGHTINGS).schema)
    out = drain(lambda ticks: fleet.effects(asked, seen, delay="2 hours", ticks=ticks), "fleet").collect()
    assert sorted(((r.job_id, r.effect, r.moment) for r in out), key=str) == plain(requests, sightings)
    assert {r.effect for r in out} == {"refused", "taken", "send", "success", "failure"}
