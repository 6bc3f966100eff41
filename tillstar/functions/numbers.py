"""Money and ratio helpers. Money is decimal from end to end."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; NULL where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def mean_money(total: Column, count: Column) -> Column:
    """``total / count`` rounded half up to cents, exact because both sides are decimal."""
    return F.round(F.try_divide(total.cast("decimal(28,2)"), count.cast("decimal(18,0)")), 2).cast(MONEY)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.lit(100.0) * ratio(part, whole), digits)


def _units(c: Column, scale: int) -> Column:
    """A decimal of at most ``scale`` places as a whole number of its smallest units."""
    return (c.cast(f"decimal(28,{scale})") * F.lit(10**scale).cast("decimal(10,0)")).cast("decimal(28,0)")


def proportional_share(amount: Column, part: Column, whole: Column, amount_scale: int = 2, part_scale: int = 2) -> Column:
    """``amount * part / whole`` rounded half up to cents; zero where ``whole`` is zero or NULL.

    Only the result is rounded: the inputs count in units of their own scales (two places at least for
    the amount), so the quotient is one of whole numbers, whatever the size.
    """
    amount_scale = max(2, amount_scale)
    product = (_units(amount, amount_scale).cast("decimal(19,0)") * _units(part, part_scale).cast("decimal(19,0)")).cast("decimal(38,0)")
    size = F.abs(_units(whole, part_scale) * F.lit(10 ** (amount_scale - 2)).cast("decimal(10,0)")).cast("decimal(37,0)")
    cents = F.call_function("div", (F.abs(product) * 2 + size).cast("decimal(38,0)"), F.nullif((size * 2).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")))
    signed = F.when((product < 0) != (whole < 0), -cents).otherwise(cents)
    return F.coalesce((signed * F.lit("0.01").cast("decimal(3,2)")).cast(MONEY), F.lit(0).cast(MONEY))


def grouped_number(c: Column, digits: int = 0) -> Column:
    """Digits grouped by ``.`` with ``,`` before the decimals."""
    return F.translate(F.format_number(c, digits), ",.", ".,")


def currency_text(c: Column, digits: int = 2, symbol: str = "R$ ") -> Column:
    return F.concat(F.lit(symbol), grouped_number(c, digits))


def timestamp_text(c: Column) -> Column:
    return F.date_format(c, "dd/MM/yyyy HH:mm:ss")
