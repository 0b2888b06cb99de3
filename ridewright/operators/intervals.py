"""Waiting for something to happen within a time limit, as joins over past data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# How long a device may take to acknowledge, and a rider to choose.
ACK_LIMIT_SECONDS = 360
CHOICE_LIMIT_SECONDS = 400

# A command is sent up to six times, a minute apart.
SENDS = 6
RESEND_SECONDS = 60

# The states a device can be commanded into.
COMMANDS = ["locked", "unlocked"]


def state_bits(state: Column) -> Column:
    """A bit for each state that can be commanded, none for any other: several states of an instant fit one number."""
    bits = F.lit(0)
    for i, name in enumerate(COMMANDS):
        bits = F.when(state == name, F.lit(1 << i)).otherwise(bits)
    return bits


def _bucket(ts: Column, seconds: int) -> Column:
    micros = F.unix_micros(ts.cast("timestamp"))
    return F.call_function("div", micros, F.lit(seconds * 1_000_000).cast("bigint"))


def acknowledged(
    commands: DataFrame, updates: DataFrame, limit: int = ACK_LIMIT_SECONDS
) -> DataFrame:
    """First moment each command's state is seen, from its own instant up to ``limit`` seconds on.

    ``commands``: device_id, ts, command and any other columns; ``updates``: device_id, ts, state.
    A device already in the commanded state acknowledges at once, and a command without a device
    counts as done. A device that reports several states for one instant is in each of them until its
    next report. Adds ``ack_ts`` and ``acked``.

    Time is cut into buckets as long as the limit, so an answer lies in the command's bucket or
    the next one. Sorting happens per (device, bucket) over distinct instants; what crosses a
    bucket border (the state before it, the first sightings after it) comes from one summary row
    per bucket. A device with most of the rows is thereby spread over its buckets.
    """
    instants = (
        updates.where(F.col("state").isNotNull() & (F.col("device_id") != ""))
        .groupBy("device_id", "ts")
        .agg(F.bit_or(state_bits(F.col("state"))).alias("states"))
    )
    asked = commands.where(F.col("device_id") != "").select("device_id", "ts", "command").distinct()
    points = (
        instants.unionByName(asked, allowMissingColumns=True)
        .withColumn("bucket", _bucket(F.col("ts"), limit))
        .select("device_id", "bucket", "ts", "states", "command")
    )

    def sighting(state: str) -> Column:
        return F.min(F.when(F.col("states").bitwiseAND(state_bits(F.lit(state))) != 0, F.col("ts")))

    piece = ["device_id", "bucket"]
    summary = points.groupBy(*piece).agg(
        F.max_by("states", F.when(F.col("states").isNotNull(), F.col("ts"))).alias("last_states"),
        *[sighting(s).alias(f"first_{s}") for s in COMMANDS],
    )
    along = Window.partitionBy("device_id").orderBy("bucket")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    adjacent = F.lead("bucket").over(along) == F.col("bucket") + 1
    borders = summary.select(
        *piece,
        F.last("last_states", ignorenulls=True).over(before).alias("carried"),
        *[
            F.when(adjacent, F.lead(f"first_{s}").over(along)).alias(f"later_{s}")
            for s in COMMANDS
        ],
    )
    # the states known at an instant come from the rows up to it, the next sightings from one pass backwards
    up_to = Window.partitionBy(*piece).orderBy("ts").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    back_to = Window.partitionBy(*piece).orderBy(F.desc("ts")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    local = points.select(
        *piece,
        "ts",
        "command",
        F.last("states", ignorenulls=True).over(up_to).alias("now"),
        *[sighting(s).over(back_to).alias(f"next_{s}") for s in COMMANDS],
    ).where(F.col("command").isNotNull())

    seen_at = F.coalesce(
        *[
            F.when(F.col("command") == s, F.coalesce(f"next_{s}", f"later_{s}"))
            for s in COMMANDS
        ]
    )
    in_time = seen_at <= F.col("ts") + F.expr(f"interval {limit} seconds")
    answers = local.join(borders, piece).select(
        "device_id",
        "ts",
        "command",
        F.when(F.coalesce("now", "carried").bitwiseAND(state_bits(F.col("command"))) != 0, F.col("ts"))
        .when(in_time, seen_at)
        .alias("_ack"),
    )
    return (
        commands.join(answers, ["device_id", "ts", "command"], "left")
        .withColumn("ack_ts", F.when(F.col("device_id") == "", F.col("ts")).otherwise(F.col("_ack")))
        .withColumn("acked", F.col("ack_ts").isNotNull())
        .drop("_ack")
    )


def sends(answered: DataFrame) -> DataFrame:
    """Every time a command goes out: at once, then each minute until it is acknowledged.

    ``answered`` is the result of :func:`acknowledged`. Commands without a device are not sent.
    """
    tries = answered.where(F.col("device_id") != "").withColumn(
        "attempt", F.explode(F.sequence(F.lit(0), F.lit(SENDS - 1)))
    )
    at = F.col("ts") + F.make_dt_interval(secs=F.col("attempt") * RESEND_SECONDS)
    return tries.withColumn("sent_at", at).where(
        (F.col("attempt") == 0) | F.col("ack_ts").isNull() | (F.col("sent_at") < F.col("ack_ts"))
    )


def payment_choices(
    rides: DataFrame, choices: DataFrame, limit: int = CHOICE_LIMIT_SECONDS
) -> DataFrame:
    """Whether each ended ride is paid in tokens.

    The first non-null choice counts if it was stored before the ride's end or arrives within
    ``limit`` seconds of it; without one the ride is paid in fiat. ``choices``: ride_id, ts,
    by_token.
    """
    first = (
        choices.where(F.col("by_token").isNotNull())
        .groupBy("ride_id")
        .agg(
            F.min_by("by_token", F.struct("ts", "by_token")).alias("_choice"),
            F.min("ts").alias("_at"),
        )
    )
    in_time = F.col("_at") <= F.col("end_time") + F.expr(f"interval {limit} seconds")
    return (
        rides.join(first, "ride_id", "left")
        .withColumn("by_token", F.coalesce(F.when(in_time, F.col("_choice")), F.lit(False)))
        .drop("_choice", "_at")
    )
