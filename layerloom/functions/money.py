"""Exact money aggregates.

Amounts are summed with all the digits they have and rounded once, when a group
is finished. The mean is rounded half up from the exact quotient, never from an
already rounded one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Digits kept of each amount whose type does not say how many it has: far below what a sum of them can show.
FLOAT_SCALE = 12
_WIDEST = 38


def exact(df: DataFrame, name: str) -> Column:
    """An amount column as a decimal that loses nothing when it is summed."""
    kind, amount = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return amount.cast(f"decimal({_WIDEST},{FLOAT_SCALE})")
    return amount if isinstance(kind, T.DecimalType) else amount.cast("decimal(20,0)")


def total(amount_sum: Column) -> Column:
    """An exact sum, rounded half up to two digits."""
    return F.round(amount_sum, 2).cast("decimal(20,2)")


def mean(amount_sum: Column, n: Column, scale: int) -> Column:
    """An exact sum with ``scale`` digits over a row count, rounded half up to two digits."""
    digits = max(scale, 2)
    wide = f"decimal({_WIDEST},0)"
    units = (F.abs(amount_sum).cast(f"decimal({_WIDEST},{digits})") * F.lit(10**digits)).cast(wide)
    divisor = (n * F.lit(2 * 10 ** (digits - 2))).cast("decimal(24,0)")
    doubled = (units * 2).cast("decimal(34,0)") + (divisor / 2).cast("decimal(24,0)")
    # The remainder is dropped first, so the division is exact.
    cents = ((doubled - doubled % divisor).cast("decimal(34,0)") / divisor).cast("decimal(22,0)")
    signed = F.when(amount_sum < 0, -cents).otherwise(cents)
    return (signed / 100).cast("decimal(20,2)")
