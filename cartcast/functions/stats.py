"""Aggregate specs (D2-D6, J1) with pandas semantics (contract S2-S7).

An agg spec is a list of ``(column, [stat, ...])``; a stat is a name from
``STATS`` or a callable ``Column -> Column`` (a user aggregate, named
``{col}-mode`` as in the reference).  ``agg_columns`` turns it into aliased
Spark aggregate expressions named ``{col}-{stat}``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The seven statistics of the reference, in its two orders.
STATS7 = ["mean", "max", "min", "sum", "count", "std", "skew"]
STATS7_WINDOW = ["max", "min", "sum", "mean", "count", "std", "skew"]


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def skew(c: str | Column) -> Column:
    """Adjusted Fisher-Pearson skewness (pandas ``skew``): null for n<3, 0 for constants."""
    x = _c(c)
    n = F.count(x).cast("double")
    return (F.when(n < 3, F.lit(None).cast("double"))
            .when(F.max(x) == F.min(x), F.lit(0.0))
            .otherwise(F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2)))


def mode(c: str | Column) -> Column:
    """Most frequent non-null value; smallest value on ties."""
    return F.mode(_c(c), deterministic=True)


def _ordering(order: Sequence[str]) -> Column:
    # one numeric column keeps the aggregation buffer fixed-width (hash
    # aggregate); a struct of several columns forces a sort-based aggregate
    return F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(o) for o in order])


def first_in_order(c: str | Column, order: Sequence[str]) -> Column:
    """First non-null value in the given order."""
    x = _c(c)
    return F.min_by(x, F.when(x.isNotNull(), _ordering(order)))


def last_in_order(c: str | Column, order: Sequence[str]) -> Column:
    x = _c(c)
    return F.max_by(x, F.when(x.isNotNull(), _ordering(order)))


def stat(c: str, name: str | Callable, order: Sequence[str] | None = None) -> Column:
    x = F.col(c)
    if callable(name):
        return name(x)
    if name == "mean":
        return F.avg(x)
    if name == "max":
        return F.max(x)
    if name == "min":
        return F.min(x)
    if name == "sum":
        return F.coalesce(F.sum(x), F.lit(0.0))
    if name == "count":
        return F.count(x)
    if name == "std":
        return F.stddev_samp(x)
    if name == "skew":
        return skew(x)
    if name == "nunique":
        return F.count_distinct(x)
    if name == "first":
        return first_in_order(x, order)
    if name == "last":
        return last_in_order(x, order)
    if name == "mode":
        return mode(x)
    raise ValueError(f"unknown statistic {name!r}")


def stat_name(c: str, s: str | Callable, suffix: str = "") -> str:
    label = s if isinstance(s, str) else "mode"
    return f"{c}-{label}{suffix}"


def agg_columns(spec: Sequence[tuple[str, Sequence]], order: Sequence[str] | None = None,
                suffix: str = "") -> list[Column]:
    """D3: ``[(col, [stats])]`` -> aliased aggregate Columns."""
    out = []
    for c, stats in spec:
        for s in stats:
            out.append(stat(c, s, order).alias(stat_name(c, s, suffix)))
    return out


def spec_names(spec: Sequence[tuple[str, Sequence]], suffix: str = "") -> list[str]:
    return [stat_name(c, s, suffix) for c, stats in spec for s in stats]
