"""Exact rounding against Python's decimal module."""

import random
from decimal import ROUND_DOWN, ROUND_HALF_UP, Decimal, localcontext

from pyspark.sql import functions as F

from ridewright.functions import money

CENT, TEN = Decimal("0.01"), Decimal("0.0000000001")


def pairs(count=2000):
    draw = random.Random(7)
    rows = [
        (Decimal("7.25"), Decimal("0.900000")),
        (Decimal("1.00"), Decimal("3.000000")),
        (Decimal("0.01"), Decimal("2.000000")),
        (Decimal("-0.01"), Decimal("2.000000")),
        (Decimal("-7.05"), Decimal("2.000000")),
        (Decimal("99999999999.99"), Decimal("0.001000")),
        (Decimal("0.00"), Decimal("1.000000")),
    ]
    for _ in range(count):
        num = Decimal(draw.randint(-(10**9), 10**9)).scaleb(-2)
        rows.append((num, Decimal(draw.randint(1, 10**8)).scaleb(-6)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "num decimal(18,2), den decimal(11,6)")


def exact(num, den, step, how):
    with localcontext() as ctx:
        ctx.prec = 60
        return (num / den).quantize(step, rounding=how)


def test_quotients(spark):
    num, den = F.col("num"), F.col("den")
    out = frame(spark, pairs()).select(
        num,
        den,
        money.token_price(num, den).alias("down2"),
        money.div_half_up(num, den, 2, money.MONEY).alias("half2"),
        money.div_down(num.cast("decimal(22,8)"), den, 10, "decimal(28,10)").alias("down10"),
        money.div_half_up(num.cast("decimal(24,10)"), den, 10, "decimal(28,10)").alias("half10"),
    )
    for row in out.collect():
        assert row.down2 == exact(row.num, row.den, CENT, ROUND_DOWN)
        assert row.half2 == exact(row.num, row.den, CENT, ROUND_HALF_UP)
        assert row.down10 == exact(row.num, row.den, TEN, ROUND_DOWN)
        assert row.half10 == exact(row.num, row.den, TEN, ROUND_HALF_UP)


def test_zero_rate_gives_null(spark):
    row = frame(spark, [(Decimal("1.00"), Decimal(0))]).select(
        money.token_price(F.col("num"), F.col("den")).alias("x")
    )
    assert row.first().x is None


def test_cents_truncate_toward_zero(spark):
    df = spark.createDataFrame([(Decimal("1.239"),), (Decimal("-1.239"),)], "x decimal(10,3)")
    cents = [r[0] for r in df.select(money.to_cents(F.col("x"))).collect()]
    assert cents == [123, -123]


def test_units_of_64_tokens(spark):
    df = spark.createDataFrame([(Decimal("64.00"),)], "x decimal(18,2)")
    units = money.to_token_units(F.col("x"))
    row = df.select(units.alias("units"), money.from_token_units(units).alias("back")).first()
    assert row.units == 64 * 10**18 and row.back == 64


def test_minutes_and_price(spark):
    df = spark.sql(
        "select timestamp_ntz '2024-01-01 00:00:00' a, timestamp_ntz '2024-01-01 00:02:59.999' b,"
        " cast(1 as decimal(18,2)) base, cast(0.15 as decimal(18,2)) ppm"
    )
    minutes = money.whole_minutes(F.col("a"), F.col("b"))
    row = df.select(minutes.alias("m"), money.ride_price(F.col("base"), F.col("ppm"), minutes).alias("p"))
    assert tuple(row.first()) == (2, Decimal("1.30"))


def test_award_never_exceeds_price_after_commission(spark):
    df = spark.createDataFrame(
        [(Decimal("10.00"), Decimal("50.00"), None, Decimal("0.2")), (Decimal("10.00"), None, Decimal("0.05"), Decimal("0.2"))],
        "t decimal(18,2), base decimal(18,2), factor decimal(7,6), cf decimal(7,6)",
    )
    got = [r[0] for r in df.select(money.token_award(*map(F.col, ["t", "base", "factor", "cf"]))).collect()]
    assert got == [Decimal("8.00000000"), Decimal("0.50000000")]


def test_two_significant_digits(spark):
    values = ["0.00", "0.07", "0.94", "9.95", "12.34", "12.50", "99.49", "99.50", "68423.46"]
    df = spark.createDataFrame([(Decimal(v),) for v in values], "x decimal(18,2)")
    got = [str(r[0]) for r in df.select(money.two_significant(F.col("x"))).collect()]
    assert got == ["0.00", "0.07", "0.94", "10.00", "12.00", "13.00", "99.00", "100.00", "68000.00"]
