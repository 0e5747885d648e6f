"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def quote_value(price: Column, qty: Column) -> Column:
    return F.round(price * qty, 8)


#: Values from here on are no amounts: the decoders set them aside.
TOO_LARGE = 1e20


def amount(value: Column) -> Column:
    """The value itself, NULL for what is not finite or TOO_LARGE."""
    return F.when(~F.isnan(value) & (F.abs(value) < TOO_LARGE), value)


def exact_sum(column: Column | str) -> Column:
    """Sum of a double rounded half up to 8 decimals, as DECIMAL(38,8).

    Adding doubles gives a result that depends on row order, and casting every row to DECIMAL costs
    more than the rest of the aggregation. So values below a million whose 1e-8 units are clearly
    nearer to one whole number are added as integers, in a high and a low part that cannot
    overflow; larger values and those about halfway between two units go through DECIMAL. No part is left
    out: a group with a value that is not finite, or with a sum from 1e29 up, which the type cannot hold, has
    NULL. The decoders set aside what is not below TOO_LARGE.
    """
    value = F.col(column) if isinstance(column, str) else column
    units = value * F.lit(1e8)
    plain = (F.abs(value) < 1e6) & (F.abs(units - F.floor(units) - 0.5) > 0.05)
    whole = F.when(plain, F.rint(units).cast("bigint"))
    high = F.sum(F.shiftright(whole, 27)).cast("decimal(18,0)") * F.lit(1 << 27).cast("decimal(9,0)")
    low = F.sum(whole.bitwiseAND(F.lit((1 << 27) - 1))).cast("decimal(18,0)")
    # One digit less than the widest type, or the sum of both parts would lose its last decimal.
    fast = ((high + low) * F.lit("0.00000001").cast("decimal(8,8)")).cast("decimal(37,8)")
    # NaN compares as larger than every number, so it is not plain.
    odd = F.when(~plain, value)
    slow = F.try_sum(odd.try_cast("decimal(38,8)")).try_cast("decimal(37,8)")
    lost = (F.count(odd) > F.count(odd.try_cast("decimal(38,8)"))) | (slow.isNull() & (F.count(odd) > 0))
    return F.when(~lost, F.coalesce(fast + slow, fast, slow).cast("decimal(38,8)"))
