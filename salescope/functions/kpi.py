"""Column helpers with the numeric semantics of the analysed T-SQL.

All are compositions of built-in expressions (JVM side, whole-stage codegen),
never UDFs.

* An average over an integer expression is an integer, truncated toward zero:
  ``sum div count`` (exact integer division; a double average would round).
* ``100.0 * a / b`` is exact decimal arithmetic; ``ROUND(x, 2)`` rounds half
  away from zero on decimals, which Spark's ``round`` does on decimals (not on
  doubles).  Percentages are rounded as decimals, then cast to double.
* Division by zero is guarded with ``nullif``: under ANSI mode it would fail.
* ``FORMAT(x, 'N2')``: thousands separators and two decimals, half away from
  zero; ``format_number`` alone rounds half-even, so round first.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def hundred() -> Column:
    """The decimal literal ``100.0`` (a double literal would make the division inexact)."""
    return F.lit(Decimal("100.0"))


def one() -> Column:
    """The decimal literal ``1.0``."""
    return F.lit(Decimal("1.0"))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_div(numerator: Column | str, denominator: Column | str) -> Column:
    """Integer division truncating toward zero; NULL when the denominator is 0.

    ``n - n % d`` is an exact multiple of ``d`` (``%`` keeps the dividend's
    sign), so the decimal quotient is exact and the cast to long loses
    nothing; a double quotient would round sums beyond 2**53.
    """
    n = _col(numerator).cast("long")
    d = F.nullif(_col(denominator).cast("long"), F.lit(0).cast("long"))
    return ((n - n % d).cast("decimal(38,0)") / d).cast("long")


def tsql_avg(values: Column | str) -> Column:
    """Aggregate: average of an integer expression, truncated toward zero."""
    v = _col(values)
    return int_div(F.sum(v), F.count(v))


def pct(part: Column | str, whole: Column | str, scale: int = 2) -> Column:
    """``ROUND(100.0 * part / whole, scale)`` as a double; NULL when whole is 0."""
    return F.round(hundred() * _col(part) / F.nullif(_col(whole), F.lit(0)), scale).cast("double")


def ratio(part: Column | str, whole: Column | str, scale: int = 2) -> Column:
    """``ROUND(part * 1.0 / whole, scale)`` as a double; NULL when whole is 0."""
    return F.round(_col(part) * one() / F.nullif(_col(whole), F.lit(0)), scale).cast("double")


def n2_percent(value: Column | str) -> Column:
    """``FORMAT(x, 'N2') + '%'``: thousands separators, half away from zero."""
    return F.concat(F.format_number(F.round(_col(value), 2), 2), F.lit("%"))
