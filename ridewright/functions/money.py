"""Exact decimal arithmetic for prices, token amounts and commissions.

Every function takes and returns decimal columns. Quotients are single integer divisions of scaled
operands, so rounding is decided on exact integers and never on a rounded quotient.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
RATE = "decimal(11,6)"
FACTOR = "decimal(7,6)"
REVENUE = "decimal(24,10)"

# Fixed value: one token is 10^18 of its smallest unit.
TOKEN_UNIT_DIGITS = 18


def _pow10(digits: int) -> Column:
    return F.lit("1" + "0" * digits).cast(f"decimal({digits + 1},0)")


def _int_div(num: Column, den: Column) -> Column:
    return F.call_function("div", num, den)


def _whole_at(num: Column, den: Column, scale: int, half: bool) -> Column:
    """``num / den`` in units of ``10^-scale`` as one integer division."""
    if half:
        doubled = num * (_pow10(scale) * F.lit(2))
        return _int_div(doubled + F.when(num < 0, -den).otherwise(den), den * F.lit(2))
    return _int_div(num * _pow10(scale), den)


def _divide(num: Column, den: Column, scale: int, out: str, half: bool) -> Column:
    safe = F.nullif(den, F.lit(0))
    direct = (_whole_at(num, safe, scale, half).cast("decimal(19,0)") * _one_at(scale)).cast(out)
    if scale <= 2:
        return direct
    # a quotient with more than 18 digits leaves the integer range: split off its integer part
    whole = _int_div(num, safe).cast("decimal(18,0)")
    rest = (num - whole * safe).cast("decimal(24,10)")
    parted = whole + _whole_at(rest, safe, scale, half).cast("decimal(19,0)") * _one_at(scale)
    fits = F.abs(num) < safe * F.lit(9 * 10 ** (17 - scale)).cast("decimal(18,0)")
    return F.when(fits, direct).otherwise(parted.cast(out))


def div_down(num: Column, den: Column, scale: int, out: str) -> Column:
    """``num / den`` truncated toward zero at ``scale`` digits; null when ``den`` is 0.

    ``num`` may hold up to ``decimal(24,10)``, the positive ``den`` up to ``decimal(18,6)``.
    """
    return _divide(num, den, scale, out, half=False)


def div_half_up(num: Column, den: Column, scale: int, out: str) -> Column:
    """``num / den`` rounded half away from zero at ``scale`` digits; null when ``den`` is 0."""
    return _divide(num, den, scale, out, half=True)


def _one_at(scale: int) -> Column:
    """``10^-scale`` as an exact decimal."""
    return F.lit("0." + "0" * (scale - 1) + "1").cast(f"decimal({scale},{scale})")


def token_price(fiat: Column, rate: Column) -> Column:
    """Fiat amount in tokens, two digits, truncated."""
    return div_down(fiat, rate, 2, MONEY)


def fiat_price(token: Column, rate: Column) -> Column:
    """Token amount in fiat, exact."""
    return token * rate


def to_cents(amount: Column) -> Column:
    """Hundredths as bigint, truncated toward zero."""
    return (amount * F.lit(100)).cast("bigint")


def from_cents(cents: Column) -> Column:
    return (cents.cast("decimal(20,0)") * _one_at(2)).cast("decimal(22,2)")


def whole_minutes(start: Column, end: Column) -> Column:
    """Full minutes between two instants, counted on whole milliseconds."""
    return _int_div(duration_millis(start, end), F.lit(60000).cast("bigint"))


def _millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def duration_millis(start: Column, end: Column) -> Column:
    return _millis(end) - _millis(start)


def ride_price(base: Column, per_minute: Column, minutes: Column) -> Column:
    return (base + per_minute * minutes.cast("decimal(9,0)")).cast(MONEY)


def commission(price: Column, factor: Column) -> Column:
    return (price * factor).cast("decimal(26,8)")


def token_award(tokens: Column, reward_base: Column, reward_factor: Column, factor: Column) -> Column:
    """Tokens granted to the rider, never more than the ride's token price after commission."""
    earned = F.coalesce(reward_base, F.lit(0).cast(MONEY)) + F.coalesce(
        tokens * reward_factor, F.lit(0).cast("decimal(26,8)")
    )
    return F.least(
        earned.cast("decimal(28,8)"), (tokens - tokens * factor).cast("decimal(28,8)")
    )


def revenue_split(
    price: Column,
    factor: Column,
    token_share: Column,
    rate: Column,
    currency: Column,
    token_code: str,
) -> tuple[Column, Column]:
    """(fiat revenue, token revenue) of one ride after commission.

    The token part is the owner's token share of the net price. Owners paid in the token currency
    have their fiat part converted by ``rate``; all others have the token part divided by it,
    half up at ten digits. The rider's payment method plays no role.
    """
    net = (price - commission(price, factor)).cast("decimal(26,8)")
    token_part = (net * token_share).cast(REVENUE)
    fiat_part = (net - token_part).cast(REVENUE)
    in_token = currency == F.lit(token_code)
    fiat = F.when(in_token, (fiat_part * rate).cast(REVENUE)).otherwise(fiat_part)
    token = F.when(in_token, token_part).otherwise(
        div_half_up(token_part, rate, 10, REVENUE)
    )
    return fiat, token


def reward_factor_of(award: Column, rate: Column, price: Column) -> Column:
    """Reward as a share of the fiat price, ten digits, truncated."""
    return div_down((award * rate).cast("decimal(22,8)"), price, 10, "decimal(28,10)")


def rider_token_change(paid_with_token: Column, price: Column, rate: Column, award: Column) -> Column:
    """What one ride does to the rider's token balance."""
    return F.when(
        F.coalesce(paid_with_token, F.lit(False)), -div_half_up(price, rate, 2, MONEY)
    ).otherwise(award)


def to_token_units(amount: Column) -> Column:
    """Smallest units of the token: hundredths truncated, then scaled exactly."""
    return (to_cents(amount).cast("decimal(19,0)") * _pow10(TOKEN_UNIT_DIGITS - 2)).cast(
        "decimal(38,0)"
    )


def from_token_units(units: Column) -> Column:
    return from_cents(_int_div(units, _pow10(TOKEN_UNIT_DIGITS - 2)))


def two_digits_text(amount: Column, scale: int) -> Column:
    """A non-negative decimal with ``scale`` places as plain text of two significant digits, half up.

    Places that rounding removes are not printed: 53000.00 is ``53000``, 4.247 is ``4.2``, 0.05 stays.
    """
    units = (amount * F.lit(10**scale)).cast("bigint")
    drop = F.greatest(F.length(units.cast("string")) - 2, F.lit(0))
    step = F.pow(F.lit(10.0), drop).cast("bigint")
    head = _int_div(units + _int_div(step, F.lit(2).cast("bigint")), step)
    places = F.lit(scale) - drop - F.when(head >= 100, 1).otherwise(0)
    value = (head * step).cast("decimal(20,0)") / F.lit(10**scale).cast("decimal(5,0)")
    text = value.cast("decimal(20,0)").cast("string")
    for n in range(1, scale + 1):
        text = F.when(places == n, value.cast(f"decimal(24,{n})").cast("string")).otherwise(text)
    return text


def two_significant(amount: Column) -> Column:
    """A non-negative ``decimal(18,2)`` amount rounded half up to two significant digits."""
    cents = to_cents(amount)
    step = F.pow(F.lit(10.0), F.greatest(F.length(cents.cast("string")) - 2, F.lit(0))).cast("bigint")
    rounded = _int_div(cents + _int_div(step, F.lit(2).cast("bigint")), step) * step
    return from_cents(rounded).cast(MONEY)
