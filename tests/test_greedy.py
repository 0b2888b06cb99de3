"""The settlement fold, plain and in blocks, against a loop."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridewright.operators import greedy

START = datetime(2024, 1, 1)


def rides(spark, owners):
    """``owners``: owner -> (position, prices in order), all in cents."""
    rows = [
        (owner, f"r{owner}-{i:06d}", START + timedelta(seconds=i), Decimal(price).scaleb(-2), Decimal(position).scaleb(-2))
        for owner, (position, prices) in owners.items()
        for i, price in enumerate(prices)
    ]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(
        rows, "owner_id bigint, ride_id string, end_time timestamp_ntz, price decimal(18,2), start decimal(22,2)"
    )


def looped(owners):
    out = {}
    for owner, (left, prices) in owners.items():
        for i, price in enumerate(prices):
            fits = price <= left
            left -= price if fits else 0
            out[f"r{owner}-{i:06d}"] = (fits, left)
    return out


def settled(frame, **limits):
    done = greedy.settle(frame, F.col("price"), F.col("start"), **limits)
    rows = done.select("ride_id", "covered", "left_cents").collect()
    assert len({r.ride_id for r in rows}) == len(rows)
    return {r.ride_id: (r.covered, r.left_cents) for r in rows}


def test_prices_of_all_owners_at_once():
    draw = random.Random(2)
    for _ in range(300):
        prices, owner, start, expected = [], [], [], []
        for o in range(draw.randint(1, 5)):
            left = draw.choice([-5, 0, 1, 2, 2**40, 2**61, draw.randrange(10**6)])
            start.append(left)
            for _ in range(draw.randint(1, 30)):
                price = draw.choice([0, 1, draw.randrange(1000), 2 ** draw.randrange(62), draw.randrange(2**61)])
                left -= price if price <= left else 0
                expected.append((None, left))
                prices.append(price)
                owner.append(o)
        covered, after, ends = greedy.fold_prices(np.array(prices), np.array(owner), np.array(start))
        assert after.tolist() == [left for _, left in expected]
        assert ends.tolist() == [expected[owner.index(o) + owner.count(o) - 1][1] for o in range(len(start))]
        begun = {o: s for o, s in enumerate(start)}
        for price, o, fits, left in zip(prices, owner, covered.tolist(), after.tolist(), strict=True):
            assert fits == (price <= begun[o]) and left == begun[o] - price * fits
            begun[o] = left


def test_skips_and_goes_on(spark):
    owners = {1: (10000, [5000, 7000, 3000])}
    got = settled(rides(spark, owners))
    assert [got[f"r1-{i:06d}"][0] for i in range(3)] == [True, False, True]


@pytest.mark.parametrize("seed", range(4))
def test_blocks_equal_the_loop(spark, seed):
    draw = random.Random(seed)
    owners = {
        1: (draw.randint(10**4, 10**6), [draw.randint(0, 5000) for _ in range(900)]),
        2: (draw.randint(0, 500), [draw.choice([1, 3, 7, 100, 10**9]) for _ in range(300)]),
        3: (-50, [0, 5, 10] * 40),
        4: (0, [0, 1] * 60),
        5: (2**40, [2**k for k in range(41)][::-1] * 3),
        6: (10**5, [10**5 - k for k in range(200)]),
        7: (700, [10, 20]),
    }
    got = settled(rides(spark, owners), max_rows=50, block_rows=40)
    assert got == looped(owners)


def test_one_owner_with_nearly_all_rides(spark):
    draw = random.Random(9)
    owners = {1: (3 * 10**6, [int(draw.lognormvariate(6, 2)) for _ in range(6000)])}
    owners.update({o: (1000, [300, 900, 200]) for o in range(2, 30)})
    got = settled(rides(spark, owners), max_rows=1000, block_rows=500)
    assert got == looped(owners)


def test_rides_without_owner_or_price_are_left_out(spark):
    frame = rides(spark, {1: (100, [50])})
    odd = frame.withColumn("owner_id", F.lit(None).cast("bigint"))
    assert len(settled(frame.unionByName(odd))) == 1


def test_block_summaries_look_at_lengths_that_occur_only(monkeypatch):
    import pyarrow as pa

    rng, tried, where = random.Random(5), [], np.where
    monkeypatch.setattr(np, "where", lambda *a: tried.append(1) or where(*a))
    for n in (1, 2, 7, 60):
        prices = [rng.choice([0, 1, rng.randrange(10**4), rng.randrange(2**62)]) >> 8 for _ in range(n)]
        batch = pa.RecordBatch.from_pydict({"start_cents": pa.array([9] * n), "price_cents": pa.array(prices, pa.int64())})
        tried.clear()
        carry = greedy._summarise(None, batch.slice(0, n // 2)) if n > 1 else None
        start, shorter, least = greedy._summarise(carry, batch.slice(n // 2))
        assert start == 9 and len(tried) <= 2 * len({p.bit_length() for p in prices})
        for size in range(greedy.LENGTHS):
            before = [sum(q for q in prices[:i] if q.bit_length() < size) for i in range(n)]
            same = [p + b for p, b in zip(prices, before, strict=True) if p.bit_length() == size]
            assert least[size] == min(same, default=greedy.NEVER)
            assert shorter[size] == sum(p for p in prices if p.bit_length() < size)
