"""Money and ratio arithmetic with exact, engine-independent rounding.

Money stays DECIMAL(18,2). Fees are decimal products rounded half-up to
cents. Ratios are computed from integers with an explicit half-up rule so
that every engine (and every rerun) lands on the same last digit.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
_INT = "decimal(38,0)"


def money(c: Column) -> Column:
    return c.cast(MONEY)


def bps_fee(amount: Column, bps) -> Column:
    """round(amount * bps / 10000, 2) in exact decimal arithmetic."""
    rate = bps.cast("decimal(10,0)") if isinstance(bps, Column) else F.lit(Decimal(int(bps)))
    return money(F.round(amount * rate * F.lit(Decimal("0.0001")), 2))


def int_div(num: Column, den: Column) -> Column:
    """floor(num / den) for non-negative integral decimals, without rounding."""
    num, den = num.cast(_INT), den.cast(_INT)
    return ((num - F.pmod(num, den)) / den).cast(_INT)


def half_up_ratio(num: Column, den: Column, places: int, scale: int = 2) -> Column:
    """round(num / den, places) as DOUBLE, half away from zero, exact.

    ``num`` and ``den`` are decimals or integers with at most ``scale``
    fractional digits; both are scaled to integers so the quotient is rounded
    from its exact value, not from a binary float. Null when den is 0.
    """
    k = F.lit(10 ** scale)
    a = F.abs(num * k).cast(_INT)
    b = F.abs(den * k).cast(_INT)
    quot = int_div(a * F.lit(2 * 10 ** places) + b, b * F.lit(2))
    sign = F.signum(num) * F.signum(den)
    return F.when(b == 0, F.lit(None).cast("double")).otherwise(
        sign * quot.cast("double") / F.lit(float(10 ** places)))


def funding_cost(break_amount: Column, age_days: Column, annual_rate: Decimal) -> Column:
    """round(break * age * rate / 365, 2) as DECIMAL(18,2), half-up, exact.

    M = break*100 * age * rate*10^4 is an integer; cents = (2M + 3650000) div 7300000.
    Inputs are non-negative (the report date is the latest window end).
    """
    rate_e4 = int((Decimal(annual_rate) * 10000).to_integral_value())
    m = (break_amount * F.lit(100)).cast(_INT) * age_days.cast(_INT) * F.lit(rate_e4)
    cents = int_div(m * F.lit(2) + F.lit(3650000), F.lit(7300000))
    return money(cents * F.lit(Decimal("0.01")))


def half_up_decimal(num: Column, den: Column, places: int, precision: int = 18, scale: int = 2) -> Column:
    """round(num / den, places) as DECIMAL(precision, places), exact half-up; null when den is 0."""
    k = F.lit(10 ** scale)
    a = F.abs(num * k).cast(_INT)
    b = F.abs(den * k).cast(_INT)
    quot = int_div(a * F.lit(2 * 10 ** places) + b, b * F.lit(2))
    signed = F.when(F.signum(num) * F.signum(den) < 0, -quot).otherwise(quot)
    unit = F.lit(Decimal(1).scaleb(-places))
    return F.when(b == 0, F.lit(None)).otherwise(signed * unit).cast(f"decimal({precision},{places})")
