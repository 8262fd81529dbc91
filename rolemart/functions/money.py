"""Exact decimal money arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

LEDGER = "decimal(32,4)"
REPORT = "decimal(36,2)"
# Narrow enough that products and quotients below stay exact inside 38 digits.
_PAYMENT = "decimal(18,4)"
_RATE = "decimal(12,6)"


def minor_to_home(money: Column, rate: Column) -> Column:
    """Amount in hundredths of a foreign unit to home currency at ``rate``, four decimals."""
    cent = F.lit("0.01").cast("decimal(3,2)")
    return (money.cast(_PAYMENT) * rate.cast(_RATE) * cent).cast(LEDGER)


def unit_price(money: Column, units: Column) -> Column:
    """money / units at four decimals; NULL instead of a failed job where units is 0."""
    return F.try_divide(money.cast("decimal(24,4)"), units.cast("decimal(18,0)")).cast(LEDGER)


def rounded_long(amount: Column) -> Column:
    """Whole units, rounded half up (a plain cast would truncate)."""
    return F.round(amount, 0).cast("bigint")
