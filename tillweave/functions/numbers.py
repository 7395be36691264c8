"""Exact money arithmetic, rounding modes and number text.

Money is summed as DECIMAL, which is exact and independent of the order rows
arrive in, and turned into DOUBLE only at the very end.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

HALF_UP, HALF_EVEN = "half_up", "half_even"


def exact_money(col: Column, dtype: T.DataType) -> Column:
    """A money column as a decimal that sums without overflow or drift."""
    if isinstance(dtype, T.DecimalType):
        return col
    if isinstance(dtype, T.IntegralType):
        return col.cast(T.DecimalType(18, 0))
    return col.cast(T.DecimalType(18, 2))


# Bits of a whole number summed apart from the rest, see exact_sum().
_LOW_BITS = 20


def exact_sum(col: Column, dtype: T.DataType) -> Column:
    """Exact sum of a money column as a decimal, independent of row order.

    Whole numbers are summed as two bigint halves: as cheap as a bigint sum,
    without its overflow on very large tables.
    """
    if not isinstance(dtype, T.IntegralType):
        return F.sum(exact_money(col, dtype))
    whole = col.cast("bigint")
    high = F.sum(F.shiftright(whole, _LOW_BITS)).cast(T.DecimalType(22, 0))
    low = F.sum(whole.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))).cast(T.DecimalType(22, 0))
    return (high * F.lit(Decimal(1 << _LOW_BITS)) + low).cast(T.DecimalType(28, 0))


def money_scale(dtype: T.DataType) -> int:
    if isinstance(dtype, T.DecimalType):
        return dtype.scale
    return 0 if isinstance(dtype, T.IntegralType) else 2


def scaled_total(total: Column, scale: int, divisor: int) -> Column:
    """`total / divisor` for a power-of-ten divisor, kept exact as a decimal."""
    exact = total.cast(T.DecimalType(28, scale))
    return exact if divisor == 1 else exact * F.lit(Decimal(1) / Decimal(divisor))


def round_decimal(col: Column, digits: int, mode: str) -> Column:
    return F.bround(col, digits) if mode == HALF_EVEN else F.round(col, digits)


def round_double(col: Column, digits: int, mode: str) -> Column:
    """Half-even scales, rounds to the nearest integer and scales back, as array libraries do."""
    if mode == HALF_EVEN:
        factor = float(10**digits)
        return F.rint(col * factor) / factor
    return F.round(col, digits)


def half_even_long(col: Column) -> Column:
    return F.rint(col).cast("bigint")


def millions_text(total: Column, digits: int = 1) -> Column:
    """`$12.3M` from an exact total."""
    value = F.bround(total * F.lit(Decimal("0.000001")), digits)
    return F.concat(F.lit("$"), value.cast(T.DecimalType(28, digits)).cast("string"), F.lit("M"))


def plus_zero(col: Column) -> Column:
    """Turn a negative zero into a plain zero."""
    return col + F.lit(0.0)


def heading(name: str) -> str:
    """Column name as a table heading."""
    return name.replace("_", " ").title()
