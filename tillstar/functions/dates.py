"""Date parts and locale-free names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names by ISO weekday (Monday first) and by month.
WEEKDAY_NAMES = (
    "Segunda-feira", "Terça-feira", "Quarta-feira", "Quinta-feira",
    "Sexta-feira", "Sábado", "Domingo",
)
MONTH_NAMES = (
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
)


def iso_weekday(d: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(d) + 1


def nth_name(position: Column, names: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


def weekday_name(d: Column, names: Sequence[str] = WEEKDAY_NAMES) -> Column:
    return nth_name(iso_weekday(d), names)


def month_name(d: Column, names: Sequence[str] = MONTH_NAMES) -> Column:
    return nth_name(F.month(d), names)


def month_key(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def quarter_label(d: Column, prefix: str = "T") -> Column:
    return F.concat(F.lit(prefix), F.quarter(d).cast("string"))


def month_index(key: Column) -> Column:
    """A running month number (year * 12 + month) from a ``yyyy-MM`` key."""
    return F.substring(key, 1, 4).cast("int") * 12 + F.substring(key, 6, 2).cast("int")


def is_weekend(d: Column) -> Column:
    return iso_weekday(d) >= 6
