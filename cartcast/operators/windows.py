"""Month-window features (K6 trend, K7 season, K9 cycle, K8 monthly grid, C4, I5, D7, D13).

The reference runs one groupby per window and anchor (24 passes) and chains the
results with right joins.  Here the log is aggregated once to mergeable moments per
customer and month; only these rows are exploded to the anchors, and a customer's few
months are merged to all windows of an anchor at once, in Arrow batches: no row is repeated per window and nothing is pivoted.
Partial aggregation keeps a hot customer's rows spread over map tasks until they are one row per month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartcast.functions.months import month_index, month_start, ym_index, ym_shift, year_month
from cartcast.functions.stats import STATS7_WINDOW, spec_names
from cartcast.operators.moments import month_moments
from cartcast.operators.states import window_stats

# Look-back months of the trend windows and start months of the
# three-month season windows.
TREND_BACK = [1, 2, 3, 5, 7, 12, 20, 23]
SEASON_BACK = [1, 6, 12, 18]
WINDOW_VALUES = ["quantity", "price", "total"]
WINDOW_SPEC = [(c, STATS7_WINDOW) for c in WINDOW_VALUES]


def _anchor_months(log: DataFrame, anchors: list[str], max_back: int) -> DataFrame:
    """Month moments before each anchor and at most ``max_back`` months back, tagged with ``year_month`` (the anchor) and
    ``back`` (months before it, >= 1): the log is read and aggregated once; only rows per customer and month are repeated."""
    anchors = sorted(anchors)
    lo = month_start(ym_shift(anchors[0], -max_back))
    cut = log.filter((F.col("order_date") >= lo) & (F.col("order_date") < month_start(anchors[-1])))
    months = month_moments(cut, WINDOW_VALUES)
    at = F.array(*[F.struct(F.lit(a).alias("year_month"), F.lit(ym_index(a)).alias("i")) for a in anchors])
    rows = months.withColumn("_a", F.explode(F.filter(at, lambda a: (a["i"] > F.col("_mi")) & (a["i"] - F.col("_mi") <= max_back))))
    return rows.select("*", F.col("_a.year_month").alias("year_month"), (F.col("_a.i") - F.col("_mi")).alias("back")).drop("_a")


def window_labels(trend: bool = True, season: bool = True) -> list[str]:
    out = []
    if trend:
        out += [str(i) for i in range(len(TREND_BACK))]
    if season:
        out += [f"season{i}" for i in range(len(SEASON_BACK))]
    return out


def window_list(trend: bool = True, season: bool = True) -> list[tuple[str, int, int]]:
    """Windows as (name, a, b): the months from a to b back."""
    windows = [(str(i), 1, k) for i, k in enumerate(TREND_BACK)] if trend else []
    return windows + ([(f"season{i}", k, k + 2) for i, k in enumerate(SEASON_BACK)] if season else [])


def window_wide(log: DataFrame, anchors: list[str], trend: bool = True, season: bool = True) -> DataFrame:
    """One row per (customer, anchor), columns ``{col}-{stat}-{i}`` (trend) / ``{col}-{stat}-season{i}`` (season).  Counts
    are doubles: in the reference they pass through merges that leave NaN."""
    windows = window_list(trend, season)
    rows = _anchor_months(log, anchors, max(high for _, _, high in windows))
    return window_stats(rows, ["customer_id", "year_month"], windows, WINDOW_SPEC)


def trend_features(log: DataFrame, anchors: list[str]) -> DataFrame:
    """K6: 8 trend windows x 21 stats per (customer, anchor)."""
    return window_wide(log, anchors, True, False)


def season_features(log: DataFrame, anchors: list[str], compat: bool = False) -> DataFrame:
    """K7: 4 season windows x 21 stats.  ``compat=True`` keeps the reference's
    right-join chain result: only customers active in the last season window
    keep season values."""
    wide = window_wide(log, anchors, False, True)
    if compat:
        last = f"total-count-season{len(SEASON_BACK) - 1}"
        wide = wide.filter(F.col(last).isNotNull())
    return wide


def trend_season_features(log: DataFrame, anchors: list[str], compat: bool = False) -> DataFrame:
    """K6 + K7 in one pass."""
    wide = window_wide(log, anchors, True, True)
    return compat_seasons(wide) if compat else wide


def compat_seasons(wide: DataFrame) -> DataFrame:
    """``wide`` with season values only where the last season window has rows, as the reference's right-join chain leaves them."""
    keep = F.col(f"total-count-season{len(SEASON_BACK) - 1}").isNotNull()
    return wide.select(*[F.when(keep, F.col(c)).alias(c) if "-season" in c else F.col(f"`{c}`") for c in wide.columns])


def cycle_1224(log: DataFrame, anchors: list[str]) -> DataFrame:
    """K9: (spend 12 months before + spend 24 months before) / 2, missing as 0,
    for customers with a row in either month."""
    anchors = sorted(anchors)
    cut = log.filter((F.col("order_date") >= month_start(ym_shift(anchors[0], -24))) & (F.col("order_date") < month_start(anchors[-1])))
    months = cut.groupBy("customer_id", month_index("order_date").alias("_mi")).agg(F.sum("total").alias("_t"))
    at = F.array(*[F.struct(F.lit(a).alias("year_month"), F.lit(ym_index(a)).alias("i")) for a in anchors])
    back = F.col("_a.i") - F.col("_mi")
    rows = months.withColumn("_a", F.explode(F.filter(at, lambda a: (a["i"] - F.col("_mi")).isin(12, 24))))
    rows = rows.select("customer_id", F.col("_a.year_month").alias("year_month"), back.alias("back"), "_t")
    half = lambda k: F.coalesce(F.sum(F.when(F.col("back") == k, F.col("_t"))), F.lit(0.0))
    return rows.groupBy("customer_id", "year_month").agg(((half(12) + half(24)) / 2).alias("cycle_1224"))


def month_pivot(log: DataFrame, months: list[str]) -> DataFrame:
    """Spend per customer with the given months as columns (0 when absent),
    for customers with any row in the input."""
    ym = year_month("order_date")
    g = (log.select("customer_id", ym.alias("ym"), "total")
            .groupBy("customer_id").pivot("ym", months).agg(F.sum("total")))
    return g.select("customer_id", *[F.coalesce(F.col(m), F.lit(0.0)).alias(m) for m in months])


def _span(log: DataFrame):
    r = log.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi")).first()
    return r["lo"], r["hi"]


def calendar_days(log: DataFrame) -> DataFrame:
    """I5 + D13: days of the calendar between the first and last order day,
    counted per month."""
    lo, hi = _span(log)
    days = F.sequence(F.to_date(F.lit(str(lo.date()))), F.to_date(F.lit(str(hi.date()))), F.expr("interval 1 day"))
    d = log.sparkSession.range(1).select(F.explode(days).alias("day"))
    return (d.groupBy(F.date_format("day", "yyyy-MM").alias("year_month"))
             .agg(F.count("*").alias("days")))


def calendar_grid(log: DataFrame) -> DataFrame:
    """C4 at month grain: every customer of the log x every month of its span."""
    lo, hi = _span(log)
    months = F.sequence(F.lit(f"{lo:%Y-%m}-01").cast("date"), F.lit(f"{hi:%Y-%m}-01").cast("date"),
                        F.expr("interval 1 month"))
    cust = log.select("customer_id").distinct()
    grid = cust.select("customer_id", F.explode(months).alias("_m"))
    return grid.select("customer_id", F.date_format("_m", "yyyy-MM").alias("year_month"))


def monthly_dense(log: DataFrame, ym: str) -> DataFrame:
    """K8 + C5 sliced to one month: every customer of the log with its spend in
    ``ym`` (0 when it bought nothing then).  The grid restricted to one month is
    the customer list, so the grid itself is never materialised."""
    spend = (log.filter((F.col("order_date") >= month_start(ym)) & (F.col("order_date") < month_start(ym_shift(ym, 1))))
                .groupBy("customer_id").agg(F.sum("total").alias("_t")))
    cust = log.select("customer_id").distinct()
    return (cust.join(spend, "customer_id", "left")
                .select("customer_id", F.lit(ym).alias("year_month"),
                        F.coalesce(F.col("_t"), F.lit(0.0)).alias("total")))
