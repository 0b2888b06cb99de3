"""The end of a ride: which rows meet, and what is shuffled for it."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ridewright.checks.queries import QUERIES
from ridewright.checks.views import Views
from ridewright.operators import rides
from ridewright.operators.lookup import one_per_key

START, END = datetime(2024, 1, 1, 8), datetime(2024, 1, 1, 9)


@pytest.fixture
def shuffled(spark):
    """All joins shuffle, and the whole plan is known before it runs."""
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def plan_lines(df) -> list[str]:
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def below(lines: list[str], at: int) -> list[str]:
    """The lines of the node ``at`` and of all below it."""
    depth = lambda line: next(i for i, c in enumerate(line) if c not in " :+-")
    found = [lines[at]]
    for line in lines[at + 1 :]:
        if not line.strip(" :+-") or depth(line) <= depth(lines[at]):
            break
        found.append(line)
    return found


def end_of_rides(spark):
    ended = spark.createDataFrame(
        [("a", END, "p1"), ("a", END, "p2"), ("b", END, "p3"), ("c", END, "p4"), ("d", END, "p5"), ("none", END, "p6")],
        "ride_id string, end_time timestamp, parking_image_url string",
    )
    active = spark.createDataFrame(
        [("a", 1, 10, END), ("a", 2, 10, START), ("b", 3, 20, START), ("c", 4, 30, START), ("d", 5, 99, START)],
        "ride_id string, rider_id bigint, vehicle_id bigint, start_time timestamp",
    )
    vehicles = spark.createDataFrame(
        [(10, 7), (20, 8), (20, 8), (30, None), (40, 7)], "vehicle_id bigint, owner_id bigint"
    ).select(
        "*",
        F.concat(F.lit("dev-"), F.col("vehicle_id")).alias("device_id"),
        *[F.lit(1).cast("decimal(18,2)").alias(c) for c in ("base_price", "price_per_minute", "reward_base", "reward_factor")],
    )
    owners = spark.createDataFrame(
        [(7, "USD"), (8, "XXX"), (8, "USD"), (9, "USD")], "owner_id bigint, currency_code string"
    ).select(
        "*",
        *[F.lit(0).cast("decimal(7,6)").alias(c) for c in ("commission_factor", "token_share")],
        F.lit("firm").alias("company_name"),
        F.lit("vendor").alias("vendor_id"),
    )
    rates = spark.createDataFrame([("USD", Decimal("0.25"))], "currency_code string, rate decimal(11,6)")
    return rides.enrich_end_ride(ended, active, vehicles, owners, rates)


def test_rows_that_meet_at_the_end_of_a_ride(spark):
    got = end_of_rides(spark).select("parking_image_url", "rider_id", "vehicle_id", "owner_id", "currency_code", "rate")
    quarter, one = Decimal("0.250000"), Decimal("1.000000")
    # ride c has a vehicle without owner, d one that is not known; vehicle 20 and owner 8 come twice
    assert sorted(tuple(r) for r in got.collect()) == sorted(
        [("p1", 2, 10, 7, "USD", quarter), ("p2", 2, 10, 7, "USD", quarter)]
        + [("p3", 3, 20, 8, "USD", quarter), ("p3", 3, 20, 8, "XXX", one)] * 2
    )


def test_rides_are_not_shuffled_by_owner_or_currency(spark, shuffled):
    lines = plan_lines(end_of_rides(spark))
    for key in ("owner_id", "currency_code"):
        at = [i for i, line in enumerate(lines) if f"Exchange hashpartitioning({key}" in line]
        assert at, key
        assert not [line for i in at for line in below(lines, i) if "parking_image_url" in line]


@pytest.mark.parametrize("turned", [False, True])
def test_first_of_equal_rows_is_the_least(spark, turned):
    rows = [(1, 5, "b"), (1, 5, "a"), (1, 6, "0"), (2, None, "z"), (2, 1, "a")]
    df = spark.createDataFrame(rows[::-1] if turned else rows, "k int, at int, v string").coalesce(1)
    got = one_per_key(df, ["k"], ["at"])
    assert got.columns == ["k", "at", "v"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, 5, "a"), (2, None, "z")]


def test_first_row_may_hold_values_without_order(spark):
    df = spark.sql("select * from values (1, 2, map('x', 2)), (1, 1, map('x', 1)) as t (k, at, m)")
    assert [tuple(r) for r in one_per_key(df, ["k"], ["at"]).collect()] == [(1, 1, {"x": 1})]


def test_order_columns_are_shuffled_once(spark):
    df = spark.createDataFrame([(1, 5, "b")], "k int, at int, v string")
    assert not any("min_by" in line for line in plan_lines(one_per_key(df, ["k"], ["at"])))


def tables(spark, folder):
    """Orders 1, 1 and 97 with three rides, one of them twice and one without an end, and one line without order."""
    lines = [(1, 10, 7, 1), (1, 10, 7, 1), (97, 20, 8, 2), (2, 10, 7, 3), (None, 10, 7, 4)]
    rows = {
        "lineitem": spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int").selectExpr(
            "*", "2D l_quantity", "10D l_extendedprice", "'A' l_returnflag", "'F' l_linestatus"
        ),
        "orders": spark.createDataFrame([(1, 5), (1, 4), (97, 6)], "o_orderkey bigint, o_custkey bigint"),
        "part": spark.createDataFrame([(10, 3), (20, 4)], "p_partkey bigint, p_size int").selectExpr("*", "'t' p_type", "'b' p_brand"),
        "supplier": spark.range(3).selectExpr("id s_suppkey", "'s' s_name", "1D s_acctbal"),
    }
    for name, df in rows.items():
        df.write.parquet(f"{folder}/{name}.parquet")


@pytest.mark.parametrize("name", ["ride_summary", "effective_date_copy", "ride_price", "enrich_end_ride"])
def test_both_readers_of_the_rides_share_their_shuffles(spark, folder, shuffled, name):
    tables(spark, folder)
    df = QUERIES[name](spark, folder)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # a query turns it on; it finds equal shuffles while it runs
    lines = plan_lines(df)
    for read in ("l_orderkey", "o_orderkey"):
        assert len([line for line in lines if f"FileScan parquet [{read}" in line]) == 1, read
    assert len([line for line in lines if "ReusedExchange" in line and "l_orderkey" in line]) == 1
    # each of the four rows that the order's repeats make of a ride finds the rider that comes first
    found = df.collect()
    assert [r.ride_id for r in found] == ["1-10-7-1"] * 4
    if name == "ride_summary":
        assert {(r.rider_id, r.vehicle_id, r.owner_id, r.last_geohash, r.auth_transaction_id) for r in found} == {
            (4, 10, 1, "to-4", "auth-1-10-7-1")
        }


def test_shared_rows_are_those_of_the_table(spark, folder):
    tables(spark, folder)
    v, columns = Views(spark, folder), ["ride_id", "end_time", "k"]
    assert v.shared("rides", *columns).schema == v.rides.select(*columns).schema
    assert sorted(map(str, v.shared("rides", *columns).collect())) == sorted(map(str, v.rides.select(*columns).collect()))
