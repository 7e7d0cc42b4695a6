"""Month arithmetic.

Anchors are ``yyyy-MM`` strings handled on the driver as scalars; row-level
work uses Spark column functions only.  A cut "before month M" is a range
predicate on ``order_date`` so it reaches the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ym_parse(ym: str) -> tuple[int, int]:
    y, m = ym.split("-")
    return int(y), int(m)


def ym_shift(ym: str, k: int) -> str:
    """Shift a ``yyyy-MM`` string by ``k`` months (negative = back)."""
    y, m = ym_parse(ym)
    idx = y * 12 + (m - 1) + k
    return f"{idx // 12:04d}-{idx % 12 + 1:02d}"


def ym_index(ym: str) -> int:
    y, m = ym_parse(ym)
    return y * 12 + m - 1


def month_start(ym: str) -> Column:
    """First instant of the month as a timestamp_ntz literal (pushes down)."""
    return F.lit(f"{ym}-01 00:00:00").cast("timestamp_ntz")


def year_month(c: str | Column = "order_date") -> Column:
    """B1: ``yyyy-MM`` string of a timestamp."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM")


def month_index(c: str | Column = "order_date") -> Column:
    """Months since year 0 (year*12 + month-1), for window membership."""
    c = F.col(c) if isinstance(c, str) else c
    return F.year(c) * 12 + F.month(c) - 1


def before(ym: str, c: str = "order_date") -> Column:
    """B2: point-in-time cut, rows strictly before the first day of ``ym``."""
    return F.col(c) < month_start(ym)


def in_month(ym: str, c: str = "order_date") -> Column:
    """B3 as a range: rows inside month ``ym``."""
    return (F.col(c) >= month_start(ym)) & (F.col(c) < month_start(ym_shift(ym, 1)))


def unix_seconds(c: str | Column = "order_date") -> Column:
    """Seconds since epoch of a zone-less timestamp, as double."""
    c = F.col(c) if isinstance(c, str) else c
    # difference of two zone-less timestamps: independent of the session zone
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", epoch, c.cast("timestamp_ntz")).cast("double")


def shift_ym_col(ym_col: Column, k: int) -> Column:
    """I1+I2 on a column: parse ``yyyy-MM``, add ``k`` months, format."""
    return F.date_format(F.add_months(F.to_date(ym_col, "yyyy-MM"), k), "yyyy-MM")
