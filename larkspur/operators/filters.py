"""Filters that need more than one expression."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.operators.ranks import quantiles_by_counting


def near_median(df: DataFrame, column: str, distance: float) -> DataFrame:
    """Rows whose value lies less than ``distance`` from the exact median; none if there are no values.

    The median is looked for now, and ``df`` is read a few times for it.
    """
    found = quantiles_by_counting(df, column, [0.5])
    median = F.lit(found[0][1] if found else None).cast("double")
    return df.filter(F.abs(F.col(column) - median) < distance)


def _month_start(text: str) -> dt.date:
    year, _, month = text.partition("-")
    return dt.date(int(year), int(month or 1), 1)


def _period_end(text: str) -> dt.date:
    start = _month_start(text)
    if "-" not in text:
        return dt.date(start.year + 1, 1, 1)
    return dt.date(start.year + start.month // 12, start.month % 12 + 1, 1)


def in_period(day: Column, first: str, last: str | None = None) -> Column:
    """Between partial dates such as '2017' or '2017-03', the last one included.

    A plain range on the bare column, so it reaches the scan.
    """
    begin, end = _month_start(first), _period_end(last or first)
    return (day >= F.lit(begin)) & (day < F.lit(end))


def not_in(value: Column, excluded: list[str]) -> Column:
    """Not one of ``excluded``; a null is kept, as it equals none of them."""
    return F.coalesce(~value.isin(excluded), F.lit(True))
