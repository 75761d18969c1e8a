"""The snapshot spine: first-of-month dates, both ends included."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def as_date(value: str | date) -> date:
    if isinstance(value, datetime):
        return value.date()
    return value if isinstance(value, date) else date.fromisoformat(value)


def as_dates(spine: Iterable[str | date]) -> list[date]:
    """Sorted, distinct dates. A spine is configuration, a few dozen entries."""
    return sorted({as_date(value) for value in spine})


def month_starts(start: str | date, end: str | date) -> list[date]:
    """Driver-side spine, used as literals in filters and cutoffs."""
    first, last = as_date(start), as_date(end)
    months = range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    return [date(month // 12, month % 12 + 1, 1) for month in months]


def spine_frame(spark: SparkSession, start: str | date, end: str | date) -> DataFrame:
    """The same spine as a one-column DataFrame."""
    first = F.trunc(F.lit(as_date(start)), "MM")
    dates = F.sequence(first, F.lit(as_date(end)), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(dates).alias("snapshot_date"))
