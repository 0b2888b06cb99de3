"""Scheduled jobs: daily statistics, rider payment, token transfers, conversion rates."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridewright.functions import money
from ridewright.operators import keyed, rides, rollup, routing, settlement
from ridewright.operators.lookup import latest_per_key, one_per_key
from ridewright.plans.store import Store
from ridewright.sinks import tables as sink
from ridewright.sources import tables


def daily_stats(store: Store, now_utc: datetime, token_code: str, run_id: int) -> None:
    """Vehicle and owner rows of today and the neighbouring day, earlier day first.

    A day builds on the stored rows of the day before, so back-to-back days run in order. Only rides of the
    two days and statistics of the day before them are read. Photos that an ended ride stored meanwhile stay.
    """
    vehicles = store.read("vehicles")
    at = F.lit(now_utc).cast("timestamp")
    for turn, day in enumerate(sorted(rollup.stats_dates(now_utc))):
        batch = 2 * run_id + turn
        today_rides = store.read("rides_summary", parts=[day]).withColumnRenamed("conversion_rate", "rate")
        today = rollup.daily_vehicle_stats(tables.on_dates(today_rides, [day]), token_code)
        before = store.read("vehicle_stats_daily", parts=[day - timedelta(days=1)])
        rows = store.stage("daily_stats", batch, rollup.carry_forward(today, vehicles, before, day))
        store.table("vehicle_stats_daily").replace_part(day, rows, at, "daily_stats", batch)
        written = store.read("vehicle_stats_daily", parts=[day])
        owners = rollup.daily_owner_stats(written)
        store.table("owner_stats_daily").replace_part(day, owners, at, "daily_stats", batch)


def conversion_rates(store: Store, responses: DataFrame, token_code: str, run_id: int) -> None:
    """Newest landed quotes become the stored rates."""
    store.put("rates", tables.latest_rates(responses, token_code), "updated_timestamp", "conversion_rates", run_id)


# -- card payments ------------------------------------------------------------------------------

SETTLED = [
    "ride_id",
    "rider_id",
    "vehicle_id",
    "owner_id",
    "start_time",
    "end_time",
    "effective_date",
    "price",
    "paid_with_token",
    "token_awarded",
    "currency_code",
    "conversion_rate",
    "auth_transaction_id",
]


def _days(since: date, until: date) -> list[date]:
    return [since + timedelta(days=k) for k in range((until - since).days + 1)]


def rider_payment(store: Store, as_of: datetime, interval_ms: int, run_id: int) -> DataFrame:
    """Request payment of recently ended rides; returns the settled rides of this run.

    Rides are read by the day on which they ended, so one of any length is found and no other day is read.
    Rides that an earlier run has requested are left alone, unless their capture failed: those are requested
    again on the terms of their first settlement, and nothing of them is booked twice.
    """
    since, until = routing.look_back(as_of, interval_ms)
    ended = store.read("rides_ended", parts=_days(since.date(), until.date()))
    due = routing.payable_rides(ended, since, until).select(*SETTLED)
    asked, failed = _requests(store, run_id)
    again = None
    if asked is not None:
        due = routing.without_requests(due, asked)
        again = asked.join(failed, ["ride_id", "run"], "left_semi").drop("run")
    positions = settlement.owner_positions(store.read("owners"), store.ledger("owner_ledger"))
    settled = store.stage(
        "rider_payment",
        run_id,
        settlement.fold(settlement.with_owner_terms(due, positions)),
    )
    # rides paid with tokens ask nothing, but are noted as dealt with by this run
    requests = settlement.payment_requests(settled, store.read("riders")).unionByName(
        settled.where("paid_with_token").select("ride_id"), allowMissingColumns=True
    )
    if again is not None:
        requests = requests.unionByName(again.select(*requests.columns))
    store.stage("payment_requests", run_id, requests)
    store.stage("auth_reversals", run_id, settlement.auth_reversals(settled))
    owed = settlement.rewards_owed(settled).select(
        F.col("owner_id"), (-F.col("reward_owed")).cast(money.MONEY).alias("amount")
    )
    store.append_ledger("owner_ledger", owed, "rider_payment", run_id)
    store.send("rider_payment", run_id, settlement.token_payment_messages(settled))
    return settled


def _requests(store: Store, run_id: int) -> tuple[DataFrame | None, DataFrame]:
    """The latest request of each ride by runs before ``run_id``, and (ride_id, run) of failed captures."""
    stored = sink.stored(store.spark, f"{store.folder}/staged/payment_requests")
    failed = store.spark.createDataFrame([], "ride_id string, run bigint")
    answers = sink.stored(store.spark, store.path("capture_answers"))
    if answers is not None:
        failed = answers.where(F.col("capture_id").isNull()).select("ride_id", F.col("run").cast("bigint").alias("run"))
    if stored is None:
        return None, failed
    earlier = stored.where(F.col("batch") < run_id).withColumn("run", F.col("batch").cast("bigint")).drop("batch")
    return latest_per_key(earlier, ["ride_id"], ["run"]), failed


def apply_captures(store: Store, run_id: int, captures: DataFrame) -> None:
    """The gateway's answers to a run (ride_id, capture_id, captured_at): capture ids and payments are stored.

    A null capture id is a failure; the ride stays payable and the next run asks again.
    """
    captures.withColumn("run", F.lit(run_id)).write.mode("overwrite").parquet(f"{store.path('capture_answers')}/batch={run_id}")
    dealt = [store.spark.read.parquet(f"{store.folder}/staged/rider_payment/batch={n}") for n in _runs(store, run_id)]
    settled = keyed.union_all(dealt)
    taken = captures.where(F.col("capture_id").isNotNull())
    first = one_per_key(taken, ["ride_id"], ["captured_at", "capture_id"])
    marked = rides.mark_paid(
        settled.withColumn("capture_transaction_id", F.lit(None).cast("string")), first
    ).where(F.col("capture_transaction_id").isNotNull())
    timed = marked.join(first.select("ride_id", "captured_at"), "ride_id", "left").withColumn(
        "at", F.coalesce("captured_at", "end_time").cast("timestamp")
    )
    staged = store.stage("captures", run_id, timed.select("ride_id", "effective_date", "end_time", "at", "capture_transaction_id"))
    columns = {"capture_transaction_id": F.col("capture_transaction_id")}
    store.set("rides_summary", staged, "at", columns, "captures", run_id)
    store.set("rides_ended", staged.withColumn("end_day", F.to_date("end_time")), "at", columns, "captures", run_id)
    paid = settlement.payments(settled, store.read("riders"), captures)
    store.put("payments", paid, "transaction_time", "captures", run_id)


def _runs(store: Store, run_id: int) -> list[int]:
    """The runs whose settlements the requests of ``run_id`` may rest on: its own, and those it asked again for."""
    asked = store.spark.read.parquet(f"{store.folder}/staged/payment_requests/batch={run_id}").select("ride_id")
    settled = sink.stored(store.spark, f"{store.folder}/staged/rider_payment")
    # as many as there were runs
    runs = settled.where(F.col("batch") <= run_id).join(asked, "ride_id", "left_semi").select("batch").distinct().collect()
    return sorted({r[0] for r in runs} | {run_id})


# -- token transfers ----------------------------------------------------------------------------


def queue_transfers(store: Store, transfers: DataFrame, operator: str, rider: str, batch_id: int) -> None:
    """Transfers of closed windows wait in the queue of their sender; a window's transfer is queued once."""
    wallets = settlement.with_wallets(transfers, store.read("owners"), operator, rider)
    sender = F.when(F.col("transaction_type") == routing.RIDER_TO_OWNER, F.lit(rider)).otherwise(F.lit(operator))
    rows = wallets.select(
        F.concat_ws("/", F.date_format("window_end", "yyyyMMddHHmmss"), "transaction_type", F.col("owner_id").cast("string")).alias("transfer_id"),
        sender.alias("from_address"),
        "to_address",
        F.col("owner_id").cast("string").alias("owner_id"),
        "transaction_type",
        "amount",
        F.col("window_end").alias("queued_at"),
        F.lit("queued").alias("state"),
        F.col("window_end").alias("changed_at"),
    )
    store.put("transfers", rows, "queued_at", "queue", batch_id)


def release_transfers(store: Store, at: datetime, run_id: int) -> DataFrame:
    """Send the first queued transfer of every sender that has none in flight; returns what goes out.

    A sender's transfers go in the order of their windows. What waits stays queued for a later run.
    """
    now = store.read("transfers")
    queued, pending = now.where("state = 'queued'"), now.where("state = 'pending'")
    gated = settlement.pending_gate(queued, pending, ["queued_at", "transfer_id"])
    released = store.stage("release", run_id, gated.where("gate = 'release'").drop("gate"))
    moment = F.lit(at).cast("timestamp")
    columns = {"state": F.lit("pending"), "changed_at": moment}
    store.set("transfers", released, moment, columns, "release", run_id)
    return released


def complete_transfers(store: Store, answers: DataFrame, batch_id: int) -> None:
    """Answers (transfer_id, ok, ts) of the chain: a transfer in flight leaves the queue and frees its sender.

    One that went through is booked on the owner ledger; one that failed is kept among the failed ones.
    Answers to transfers that are not in flight are ignored.
    """
    once = one_per_key(answers.dropna(), ["transfer_id"], ["ts", "ok"])
    pending = store.read("transfers", keys=once).where("state = 'pending'")
    done = store.stage("complete", batch_id, pending.join(once, "transfer_id"))
    deltas = settlement.settled_deltas(done.where("ok")).select(
        "owner_id", F.col("delta").cast(money.MONEY).alias("amount")
    )
    store.append_ledger("owner_ledger", deltas, "transfers", batch_id)
    failed = done.where(~F.col("ok")).drop("ok", "state", "changed_at").withColumnRenamed("ts", "failed_at")
    store.land("failed_transfers", "complete", batch_id, failed)
    store.remove("transfers", done, "ts", "complete", batch_id)


def rider_balances(store: Store) -> DataFrame:
    """Token balance of every rider: the snapshot and all ledger entries."""
    totals = keyed.ledger_sum(store.ledger("rider_ledger"), "rider_id", "amount", "delta_cents")
    joined = store.read("riders").join(totals, "rider_id", "left")
    return joined.select(
        "rider_id",
        keyed.position(F.col("token_balance"), F.coalesce("delta_cents", F.lit(0))).alias("balance"),
    )
