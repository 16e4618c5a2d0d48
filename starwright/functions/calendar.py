"""Calendar attributes of a date column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from starwright.functions.scalars import date_key

# Default day and month labels, Monday and January first.
DAY_NAMES = (
    "Segunda-feira", "Terça-feira", "Quarta-feira", "Quinta-feira",
    "Sexta-feira", "Sábado", "Domingo",
)
MONTH_NAMES = (
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
)
# Fixed value: the fiscal year starts on 1 July, six months ahead of the calendar year.
FISCAL_LEAD_MONTHS = 6


def fiscal_year(day: Column) -> Column:
    return F.year(F.add_months(day, FISCAL_LEAD_MONTHS))


def fiscal_quarter(day: Column) -> Column:
    return F.quarter(F.add_months(day, FISCAL_LEAD_MONTHS))


def label(names: Sequence[str], position: Column) -> Column:
    """The ``position``-th label, counting from one."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


def calendar_columns(
    day: Column,
    day_names: Sequence[str] = DAY_NAMES,
    month_names: Sequence[str] = MONTH_NAMES,
) -> list[Column]:
    """All attributes of the calendar dimension for one date."""
    iso_day = F.weekday(day) + 1
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.dayofmonth(day).alias("day_of_month"),
        label(day_names, iso_day).alias("day_name"),
        iso_day.alias("day_of_week"),
        F.month(day).alias("month_number"),
        label(month_names, F.month(day)).alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        (iso_day > 5).alias("is_weekend"),
        fiscal_year(day).alias("fiscal_year"),
        fiscal_quarter(day).alias("fiscal_quarter"),
    ]
