"""Paying owners and riders: requests, rewards, netting, and the one-in-flight gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridewright.functions import messages, money
from ridewright.operators import greedy, keyed
from ridewright.operators.lookup import lookup
from ridewright.operators.routing import (
    OPERATOR_TO_RIDER,
    OWNER_INVOLVED,
    OWNER_TO_RIDER,
    RIDER_TO_OWNER,
    operator_transfers,
    owner_transfers,
)

# The card gateway's transaction kinds.
AUTH_ONLY = "AUTH_ONLY"
AUTH_CAPTURE = "AUTH_CAPTURE"
AUTH_REVERSAL = "AUTH_REVERSAL"

SETTLEMENT_WINDOW = "4 hours"


def owner_positions(owners: DataFrame, ledger: DataFrame) -> DataFrame:
    """Owners with their token position; owners without a ledger entry are dropped."""
    totals = keyed.ledger_sum(ledger, "owner_id", "amount", "delta_cents")
    found = lookup(owners, totals, ["owner_id"], take=["delta_cents"])
    return found.withColumn(
        "position", keyed.position(F.col("token_balance_base"), F.col("delta_cents"))
    )


def with_owner_terms(rides: DataFrame, positions: DataFrame) -> DataFrame:
    """Payable rides with owner terms, position and token price; rides of unknown owners drop.

    Rate and currency are those stored on the ride when it ended, not today's; a ride without a rate
    counts at rate 1.
    """
    terms = lookup(rides, positions, ["owner_id"], take=["commission_factor", "vendor_id", "position"])
    rate = F.coalesce(F.col("conversion_rate"), F.lit(1)).cast(money.RATE)
    return terms.withColumn("conversion_rate", rate).withColumn(
        "token_price", money.token_price(F.col("price"), F.col("conversion_rate"))
    )


def fold(rides: DataFrame, **limits: int) -> DataFrame:
    """Card-paid rides tagged with whether the owner's token position covers them.

    Rides paid with tokens use up no position and earn no award here; they pass through with null tags.
    """
    with_token = F.coalesce(F.col("paid_with_token"), F.lit(False))
    folded = greedy.settle(rides.where(~with_token), F.col("token_price"), F.col("position"), **limits)
    return folded.unionByName(rides.where(with_token), allowMissingColumns=True)


def payment_requests(settled: DataFrame, riders: DataFrame) -> DataFrame:
    """One gateway request per settled card ride.

    The owner funds the reward of a covered ride in tokens; otherwise the reward is added to the
    commission. Rides paid with tokens ask nothing of the gateway. The rider's payment method is a plain join.
    """
    card = settled.where(~F.coalesce(F.col("paid_with_token"), F.lit(False)))
    known = lookup(card, riders, ["rider_id"], take=["payment_method_id"])
    percent = ((F.col("commission_factor") + reward_commission(known)) * F.lit(100)).cast("decimal(28,10)")
    return known.select(
        "ride_id",
        "rider_id",
        "owner_id",
        "covered",
        F.lit(AUTH_CAPTURE).alias("card_transaction_type"),
        F.col("payment_method_id").alias("vaulted_shopper_id"),
        F.col("currency_code").alias("currency"),
        F.col("price").alias("amount"),
        F.array(F.struct(F.col("vendor_id"), percent.alias("commission_percent"))).alias("vendors"),
    )


def authorisation(kind: str, shopper: Column, currency: Column, amount: Column) -> Column:
    """Body of a request that is not split between vendors (authorise, reverse)."""
    return messages.to_message(
        cardTransactionType=F.lit(kind),
        vaultedShopperId=shopper,
        currency=currency,
        amount=amount,
    )


def auth_reversals(settled: DataFrame) -> DataFrame:
    """Requests that give back what was authorised when the ride began, also for rides paid with tokens."""
    held = settled.where(F.col("auth_transaction_id").isNotNull())
    return held.select(
        "ride_id",
        messages.to_message(
            cardTransactionType=F.lit(AUTH_REVERSAL), transactionId=F.col("auth_transaction_id")
        ).alias("request"),
    )


def payments(settled: DataFrame, riders: DataFrame, captures: DataFrame) -> DataFrame:
    """A row for each card ride that was captured.

    ``captures``: ride_id, capture_id (null if it failed), captured_at; of several answers to a ride the first
    capture counts.
    """
    card = settled.where(~F.coalesce(F.col("paid_with_token"), F.lit(False)))
    taken = lookup(
        card,
        captures.where(F.col("capture_id").isNotNull()),
        ["ride_id"],
        take=["capture_id", "captured_at"],
        first_by=["captured_at", "capture_id"],
    )
    known = lookup(taken, riders, ["rider_id"], take=["payment_method_id"])
    return known.select(
        "ride_id",
        "owner_id",
        "rider_id",
        F.col("captured_at").alias("transaction_time"),
        F.col("capture_id").alias("transaction_id"),
        F.col("payment_method_id").alias("vaulted_shopper_id"),
        "vendor_id",
        "commission_factor",
        reward_commission(known).alias("reward_commission_factor"),
        "currency_code",
        F.col("price").alias("amount"),
    )


def reward_commission(settled: DataFrame) -> Column:
    """The share of the price that pays an uncovered reward; nothing where the owner funds it in tokens."""
    return F.when(settled["covered"], F.lit(0).cast("decimal(28,10)")).otherwise(
        money.reward_factor_of(settled["token_awarded"], settled["conversion_rate"], settled["price"])
    )


def rewards_owed(settled: DataFrame) -> DataFrame:
    """Award total of each owner's covered rides, if positive."""
    return (
        settled.where("covered")
        .groupBy("owner_id")
        .agg(F.sum("token_awarded").alias("reward_owed"))
        .where(F.col("reward_owed") > 0)
    )


def reward_messages(settled: DataFrame) -> DataFrame:
    """Token transfers that pay each uncovered ride's reward from the operator."""
    return settled.where(~F.col("covered") & (F.col("token_awarded") > 0)).select(
        "ride_id",
        F.col("end_time").alias("ts"),
        F.lit(OPERATOR_TO_RIDER).alias("transaction_type"),
        "owner_id",
        F.col("token_awarded").alias("amount"),
    )


def token_payment_messages(settled: DataFrame) -> DataFrame:
    """Transfers the token settlement has to make: an owner's covered awards as one, others alone."""
    owed = rewards_owed(settled).select(
        F.lit(OWNER_TO_RIDER).alias("transaction_type"),
        "owner_id",
        F.col("reward_owed").cast(money.MONEY).alias("amount"),
    )
    own = reward_messages(settled).select(
        "transaction_type", "owner_id", F.col("amount").cast(money.MONEY).alias("amount")
    )
    body = messages.to_message(
        transactionType=F.col("transaction_type"),
        ownerId=F.col("owner_id").cast("string"),
        amount=F.col("amount"),
    )
    return owed.unionByName(own).select(F.lit("token-payment").alias("topic"), body.alias("value"))


def operator_sums(messages_df: DataFrame, ts: str = "ts") -> DataFrame:
    """One transfer per window: everything the operator owes riders."""
    return (
        operator_transfers(messages_df)
        .groupBy(F.window(ts, SETTLEMENT_WINDOW).alias("w"))
        .agg(F.sum("amount").cast("decimal(28,2)").alias("amount"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            F.lit(OPERATOR_TO_RIDER).alias("transaction_type"),
            F.lit(None).cast(messages_df.schema["owner_id"].dataType).alias("owner_id"),
            "amount",
        )
    )


def owner_netting(messages_df: DataFrame, ts: str = "ts") -> DataFrame:
    """Per owner and window, transfers both ways reduced to one; a zero net needs none."""
    signed = F.when(
        F.col("transaction_type") == OWNER_TO_RIDER, F.col("amount")
    ).otherwise(-F.col("amount"))
    return (
        owner_transfers(messages_df)
        .groupBy(F.window(ts, SETTLEMENT_WINDOW).alias("w"), "owner_id")
        .agg(F.sum(signed).cast("decimal(28,2)").alias("net"))
        .where(F.col("net") != 0)
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            F.when(F.col("net") > 0, F.lit(OWNER_TO_RIDER))
            .otherwise(F.lit(RIDER_TO_OWNER))
            .alias("transaction_type"),
            "owner_id",
            F.abs("net").alias("amount"),
        )
    )


def settlement_batch(messages_df: DataFrame, ts: str = "ts") -> DataFrame:
    """All transfers of all windows: the operator's sum and the owners' nets.

    The same rows as both branches put together, from one aggregation. On a stream it also keeps
    one watermark for all kinds, so a kind without messages holds nothing back.
    """
    kind = F.col("transaction_type")
    signed = F.when(kind == RIDER_TO_OWNER, -F.col("amount")).otherwise(F.col("amount"))
    by_operator = kind == OPERATOR_TO_RIDER
    return (
        messages_df.where(kind.isin(OPERATOR_TO_RIDER, *OWNER_INVOLVED))
        .groupBy(
            F.window(ts, SETTLEMENT_WINDOW).alias("w"),
            by_operator.alias("by_operator"),
            F.when(~by_operator, F.col("owner_id")).alias("owner_id"),
        )
        .agg(F.sum(signed).cast("decimal(28,2)").alias("net"))
        .where(F.col("by_operator") | (F.col("net") != 0))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            F.when(F.col("by_operator"), F.lit(OPERATOR_TO_RIDER))
            .when(F.col("net") > 0, F.lit(OWNER_TO_RIDER))
            .otherwise(F.lit(RIDER_TO_OWNER))
            .alias("transaction_type"),
            "owner_id",
            F.when(F.col("by_operator"), F.col("net")).otherwise(F.abs("net")).alias("amount"),
        )
    )


def with_wallets(transfers: DataFrame, owners: DataFrame, operator: str, rider: str) -> DataFrame:
    """Sender and receiver wallets. The operator's and riders' wallets are parameters.

    Owners without a wallet leave the address null.
    """
    known = lookup(
        transfers, owners, ["owner_id"], take=["wallet_address"], keep_misses=True
    )
    kind = F.col("transaction_type")
    return (
        known.withColumn(
            "from_address",
            F.when(kind == OPERATOR_TO_RIDER, F.lit(operator))
            .when(kind == OWNER_TO_RIDER, F.col("wallet_address"))
            .otherwise(F.lit(rider)),
        )
        .withColumn(
            "to_address",
            F.when(kind == RIDER_TO_OWNER, F.col("wallet_address")).otherwise(F.lit(rider)),
        )
        .drop("wallet_address")
    )


def transaction_record(transfers: DataFrame, operator: str, rider: str, at: str) -> DataFrame:
    """Row of the pending or failed table.

    The recorded sender is the rider wallet for rider-to-owner transfers and the operator wallet
    for both other kinds, also when the tokens leave an owner's wallet.
    """
    return transfers.select(
        F.when(F.col("transaction_type") == RIDER_TO_OWNER, F.lit(rider))
        .otherwise(F.lit(operator))
        .alias("from_address"),
        "to_address",
        "owner_id",
        "amount",
        "transaction_type",
        F.col(at).alias("insertion_time"),
    )


def settled_deltas(settled: DataFrame) -> DataFrame:
    """Signed ledger entries of settled owner transfers."""
    return owner_transfers(settled).withColumn(
        "delta",
        F.when(F.col("transaction_type") == OWNER_TO_RIDER, F.col("amount")).otherwise(
            -F.col("amount")
        ),
    )


def pending_gate(waiting: DataFrame, pending: DataFrame, order: list[str]) -> DataFrame:
    """Tag each waiting transfer ``release`` or ``defer``: one in flight per sender.

    A sender with a pending transfer releases nothing; otherwise its first waiting transfer goes.
    Both decisions are aggregates, so one sender may hold nearly all rows.
    """
    busy = pending.select(F.col("from_address").alias("_sender")).distinct().withColumn(
        "_busy", F.lit(True)
    )
    first = waiting.groupBy(F.col("from_address").alias("_sender")).agg(
        F.min(F.struct(*order)).alias("_first")
    )
    gate = first.join(busy, "_sender", "left").select(
        "_sender", F.when(F.col("_busy").isNull(), F.col("_first")).alias("_next")
    )
    tagged = waiting.join(gate, F.col("from_address") == F.col("_sender"), "left")
    goes = F.coalesce(F.struct(*order) == F.col("_next"), F.lit(False))
    return tagged.select(
        *waiting.columns, F.when(goes, F.lit("release")).otherwise(F.lit("defer")).alias("gate")
    )
