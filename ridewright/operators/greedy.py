"""Greedy settlement: each ride in turn is covered if its price still fits the owner's position.

A covered ride uses up its token price; a ride that does not fit is skipped and later, smaller
rides may still be covered. The result depends on the order, which is (end time, ride).

Exact parallel form for owners with very many rides: write ``c(x)`` for the bit length of ``x``.
While the remaining position R keeps its bit length c, every ride with ``c(price) < c`` fits, every
ride with ``c(price) > c`` does not, and the first fitting ride with ``c(price) = c`` shortens R.
So a block needs only, for each c, the sum of its shorter prices and the smallest
``price + shorter prices before it`` among prices of length c to tell whether R passes through it
without a change of length. Only the blocks where the length changes, at most one per bit of R,
are walked ride by ride.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridewright.functions import money
from ridewright.operators import ordered
from ridewright.session import cut_lineage

ORDER = ["end_time", "ride_id", "price_cents"]
LENGTHS = 63  # bit lengths of non-negative 62-bit cents
NEVER = np.iinfo(np.int64).max
_POWERS = np.int64(1) << np.arange(LENGTHS, dtype=np.int64)


def fold_prices(
    prices: np.ndarray, owner: np.ndarray, start: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(covered, left after each, left at the end of each owner) of rides in order, all owners together.

    ``owner`` numbers the owners from 0 in the order of the rides, ``start`` has their positions. A round takes
    every owner as far as the position keeps its bit length: shorter prices fit and add up, longer ones do not,
    and the first price of that length that fits ends the round, as does a sum that shortens the position. A
    round shortens a position by a bit at least, so there are no more rounds than bits.
    """
    covered, after = np.zeros(len(prices), bool), np.empty(len(prices), np.int64)
    left = start.copy()
    rows = np.arange(len(prices))
    while len(rows):
        price, who = prices[rows], owner[rows]
        now = left[who]
        # the least number of the position's bit length; 1 for an empty position, which only zero prices fit
        least = np.int64(1) << np.maximum(0, np.searchsorted(_POWERS, left, "right") - 1).astype(np.int64)
        floor = least[who]
        shorter = (price < floor) & (now >= 0)
        used = np.cumsum(np.where(shorter, price, 0))
        head = np.flatnonzero(np.diff(who, prepend=-1))
        length = np.diff(np.append(head, len(rows)))
        before = used[head] - np.where(shorter[head], price[head], 0)
        used -= np.repeat(before, length)
        ends = (now > 0) & np.where(shorter, now - used < floor, price <= now - used)
        # rows up to the first that ends its owner's round are settled
        position = np.arange(len(rows))
        last = np.minimum.reduceat(np.where(ends, position, len(rows)), head)
        settled = position <= np.repeat(last, length)
        at = rows[settled]
        fits = shorter | ends
        covered[at] = fits[settled]
        after[at] = (now - used - np.where(ends & ~shorter, price, 0))[settled]
        left[who[head]] = after[rows[np.minimum(last, head + length - 1)]]
        rows = rows[~settled]
    return covered, after, left


def _fold(rides: DataFrame, keys: list[str]) -> DataFrame:
    """Fold the rides of each key in order; ``keys`` is the owner, or owner and block."""

    def advance(left, first, column):
        heads = np.flatnonzero(first)
        # rides before the first head go on with the position of the batch before
        start = column("start_cents").to_numpy()[heads]
        if not len(heads) or heads[0]:
            start = np.concatenate([[left], start])
        owner = np.cumsum(first) - int(first[0])
        covered, after, ends = fold_prices(column("price_cents").to_numpy(), owner, start.astype(np.int64))
        return ends[-1], [covered, after]

    return ordered.stream_rows(
        ordered.hashed_and_sorted(rides, keys, ORDER),
        keys,
        advance,
        {"covered": "boolean", "left_cents": "bigint"},
        [c for c in rides.columns if c != "start_cents"],
    )


def _summarise(carry, batch):
    """Per bit length: sum of shorter prices, least price of that length plus shorter ones before."""
    start, shorter, least = carry or (
        batch.column("start_cents")[0].as_py(), np.zeros(LENGTHS, np.int64), np.full(LENGTHS, NEVER)
    )
    prices = batch.column("price_cents").to_numpy()
    lengths = np.searchsorted(np.int64(1) << np.arange(LENGTHS - 1, dtype=np.int64), prices, "right")
    # most owners have few rides in a block, so only lengths that occur are looked at
    sums = np.zeros(LENGTHS, np.int64)
    np.add.at(sums, lengths, prices)
    for length in np.flatnonzero(np.bincount(lengths, minlength=LENGTHS)):
        small = np.where(lengths < length, prices, 0)
        same = lengths == length
        before = shorter[length] + np.cumsum(small)  # a price of this length is not among them
        least[length] = min(least[length], (prices + before)[same].min())
    shorter[1:] += np.cumsum(sums)[:-1]
    return start, shorter, least


def _summaries(blocks: DataFrame) -> DataFrame:
    keys = ["owner_id", "block"]
    narrow = ordered.hashed_and_sorted(blocks.select(*keys, "start_cents", *ORDER), keys, ORDER)
    adds = {"start_cents": "bigint", "shorter": "array<bigint>", "least": "array<bigint>"}
    return ordered.stream_summaries(narrow, keys, _summarise, adds)


def _walk(state, first, column):
    """Carry each owner's position over block summaries up to the first block to be opened."""
    starts, opens = [], []
    for new_key, start, shorter, least, after in zip(
        first, *(column(c).to_pylist() for c in ("start_cents", "shorter", "least", "left_after"))
    ):
        left, stopped = (start, False) if new_key else state
        starts.append(None if stopped else left)
        if not stopped and after is not None:
            left = after
        elif not stopped and left > 0:
            size = left.bit_length()
            if left - shorter[size] >= 1 << (size - 1) and least[size] > left:
                left -= shorter[size]
            else:
                stopped = True
        opens.append(stopped and starts[-1] is not None)
        state = (left, stopped)
    return state, [starts, opens]


def _block_starts(blocks: DataFrame) -> DataFrame:
    """Position at the start of every block.

    Each round opens at most one block per owner and shortens the position by at least one bit, so
    there are no more rounds than bits. Rounds walk summaries; rides are read only from the opened
    partitions of the block table, whose numbers are few enough to list in the filter.
    """
    summaries = cut_lineage(_summaries(blocks))
    opened = summaries.select("owner_id", "block", F.col("start_cents").alias("left_after")).limit(0)
    while True:
        known = summaries.join(opened, ["owner_id", "block"], "left")
        walk = cut_lineage(
            ordered.stream_rows(
                ordered.hashed_and_sorted(known, ["owner_id"], ["block"]),
                ["owner_id"],
                _walk,
                {"block_start": "bigint", "must_open": "boolean"},
                ["owner_id", "block"],
            )
        ).withColumnRenamed("block_start", "start_cents")
        stops = walk.where("must_open").drop("must_open")
        numbers = [row[0] for row in stops.select("block").distinct().collect()]
        if not numbers:
            return walk.drop("must_open")
        rides = blocks.drop("start_cents").where(F.col("block").isin(numbers))
        ends = (
            _fold(rides.join(stops, ["owner_id", "block"]), ["owner_id", "block"])
            .groupBy("owner_id", "block")
            .agg(F.min("left_cents").alias("left_after"))
        )
        opened = cut_lineage(opened.unionByName(ends))


def settle(
    rides: DataFrame,
    price: Column,
    start: Column,
    *,
    max_rows: int = ordered.MAX_ROWS_PER_KEY,
    block_rows: int = ordered.BLOCK_ROWS,
) -> DataFrame:
    """The rides with ``price_cents``, ``covered`` and the owner's ``left_cents`` after each.

    ``price`` is the ride's non-negative token price, ``start`` the owner's position, the same on
    all rides of an owner; rides lacking either, or an owner, are left out. A ride uses up its
    price even though only its award is booked. All columns travel through the fold, so nothing
    has to be joined back by ride.
    """
    work = rides.withColumn("price_cents", money.to_cents(price)).withColumn(
        "start_cents", money.to_cents(start)
    )
    work = work.dropna(subset=["owner_id", "price_cents", "start_cents"])
    plain, hot, hot_rows = ordered.split_hot(work, "owner_id", max_rows, counted=rides)
    settled = _fold(plain, ["owner_id"])
    if hot is None:
        return settled
    blocks = ordered.cut_into_blocks(hot, "owner_id", ORDER, hot_rows, block_rows)
    starts = _block_starts(blocks)
    replayed = _fold(
        blocks.drop("start_cents").join(starts, ["owner_id", "block"]), ["owner_id", "block"]
    )
    return settled.unionByName(replayed.drop("block"))
