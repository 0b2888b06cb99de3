"""Hand-computed settlement, telemetry and printed amounts."""

from decimal import Decimal as D

from pyspark.sql import functions as F

from ridewright.functions import money
from ridewright.operators import settlement, telemetry



def _settled(spark):
    day = "timestamp'2024-01-01 10:0{}:00'"
    rows = [
        ("a", 50, "false", 3, "1"),
        ("b", 60, "true", 4, "1"),  # paid with tokens: uses nothing, earns nothing
        ("c", 70, "false", 5, "0.5"),  # 140 tokens at the ride's own rate: not covered
        ("d", 50, "false", 6, "1"),
        ("e", 10, "false", 7, "null"),  # no rate counts as 1; the position is used up
    ]
    text = " union all ".join(
        f"select '{r}' ride_id, 1 rider_id, 1 owner_id, {day.format(i)} end_time, cast({p} as decimal(18,2)) price, {t} paid_with_token, "
        f"cast({w} as decimal(18,2)) token_awarded, 'USD' currency_code, cast({x} as decimal(11,6)) conversion_rate"
        for i, (r, p, t, w, x) in enumerate(rows)
    )
    terms = spark.sql(
        "select 1 owner_id, 'EUR' currency_code, cast(0.1 as decimal(7,6)) commission_factor, 'v' vendor_id, "
        "cast(100 as decimal(22,2)) position"
    )
    return settlement.fold(settlement.with_owner_terms(spark.sql(text), terms))


def test_rides_paid_with_tokens_stay_out_of_the_fold(spark):
    found = {r.ride_id: (r.covered, r.left_cents) for r in _settled(spark).collect()}
    assert found == {"a": (True, 5000), "b": (None, None), "c": (False, 5000), "d": (True, 0), "e": (False, 0)}
    assert [r.reward_owed for r in settlement.rewards_owed(_settled(spark)).collect()] == [D("9.00")]
    sent = settlement.reward_messages(_settled(spark)).collect()
    assert sorted((r.ride_id, r.amount) for r in sent) == [("c", D("5.00")), ("e", D("7.00"))]


def test_requests_use_the_currency_of_the_ride(spark):
    riders = spark.sql("select 1 rider_id, 'shopper' payment_method_id")
    found = settlement.payment_requests(_settled(spark), riders).collect()
    assert sorted(r.ride_id for r in found) == ["a", "c", "d", "e"]
    assert {r.currency for r in found} == {"USD"}


def test_battery_comes_from_the_newest_message_that_has_one(spark):
    updates = spark.sql(
        "select 'x' device_id, timestamp'2024-01-01 00:00:01' ts, 50 battery_percentage, cast(null as double) battery_voltage, "
        "'locked' state, cast(null as string) geohash, cast(null as double) lat, cast(null as double) lon "
        "union all select 'x', timestamp'2024-01-01 00:00:02', null, 32D, null, null, null, null"
    )
    row = telemetry.latest_fields(updates, ["ts"]).first()
    assert (row.battery_percentage, row.battery_voltage, row.state) == (None, 32.0, "locked")


def test_printed_amounts(spark):
    cases = {"4.247": "4.2", "53000.00": "53000", "0.05": "0.05", "0.50": "0.50", "1.00": "1.0", "99.60": "100", "9.96": "10", "0.996": "1.0", "0": "0.000"}
    for text, expected in cases.items():
        scale = 3 if len(text.partition(".")[2]) in (0, 3) else 2
        value = F.lit(text).cast(f"decimal(18,{scale})")
        assert spark.range(1).select(money.two_digits_text(value, scale)).first()[0] == expected, text
