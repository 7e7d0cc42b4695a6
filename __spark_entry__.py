"""

Every query reads the given tables (or data Spark derives from them) at full
size.  Double results that come out of aggregations are passed through
the same rounding in both engines (see ``_norm_col``: plain IEEE steps,
``_fl`` / ``_fsql``) so that last-bit differences of summation order do not
break the value hash; the library itself returns full doubles.
"""

from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartcast.functions.months import before, in_month, unix_seconds, year_month, ym_shift
from cartcast.functions.months import shift_ym_col as WN_shift
from cartcast.functions.stats import STATS7, STATS7_WINDOW, agg_columns, mode
from cartcast.operators import labels as LB
from cartcast.operators import rowfeat as RF
from cartcast.operators import windows as WN
from cartcast.plans import features as FE
from cartcast.session import cleaned, kept
from cartcast.sources.tables import LOG_ORDER, read_table, transactions
from sqlcheck import features as SQ

SF_SMOKE = "/root/testdata/sf0.001"
TARGET = "2001-07"            # last full month of the test tables
TRAIN = ym_shift(TARGET, -1)  # 2001-06

_Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_S: dict[str, str] = {}


def _reg(name: str, sql: str | None = None):
    def deco(fn):
        _Q[name] = fn
        if sql is not None:
            _S[name] = sql
        return fn
    return deco


# Check-only normalisation of doubles, the same IEEE steps in Spark and DuckDB: whole
# hundredths (cents, seconds, counts) exactly; of other values, |x| < 1e-9 becomes 0, the rest is scaled
# by pi/4 (so decimal data never sits on a binary tie), cut to 26 significant bits (Veltkamp split) and scaled back.
_SPLIT = 2 ** 27 + 1
_SCALE = 0.7853981633974483


def _norm_col(c):
    z = F.when(F.abs(c) < F.lit(1e-9), F.lit(0.0)).otherwise(c.cast("double"))
    cents = F.rint(z * F.lit(100.0))
    t = z * F.lit(_SCALE)
    x = t * F.lit(float(_SPLIT))
    return F.when(F.abs(z * F.lit(100.0) - cents) < F.lit(1e-4), cents / F.lit(100.0)).otherwise((x - (x - t)) / F.lit(_SCALE))


def _norm_sql(c: str) -> str:
    return SQ.norm(c)


def _fl(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Normalise double columns (all, or ``cols``) for the value hash."""
    hit = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType) and (cols is None or f.name in cols)]
    if len(hit) < 3:
        return df.withColumns({c: _norm_col(F.col(f"`{c}`")) for c in hit})
    # one function over an array: hundreds of copies of it would be too much code for one method
    values = F.transform(F.array(*[F.col(f"`{c}`") for c in hit]), _norm_col)
    at = {c: F.get("_norm", F.lit(i)).alias(c) for i, c in enumerate(hit)}
    return df.withColumn("_norm", values).select(*[at.get(c, F.col(f"`{c}`")) for c in df.columns])


def _fsql(inner: str, doubles: list[str]) -> str:
    if not doubles:
        return inner
    rep = ", ".join(f'{_norm_sql(chr(34) + c + chr(34))} AS "{c}"' for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM ({inner}) _q"


def _log(spark, sf, description=False, country=False):
    return transactions(spark, sf, description=description, country=country)


# ----------------------------------------------------------------- SQL pieces

TXN, ORD, KEYCOLS = SQ.TXN, SQ.ORD, SQ.KEYCOLS


def _ts(ym: str) -> str:
    return f"TIMESTAMP '{ym}-01 00:00:00'"


def W(*ctes: str) -> str:
    return "WITH " + ",\n".join((TXN,) + ctes) + "\n"


def sql_skew(x: str) -> str:
    return (f"CASE WHEN count({x}) < 3 THEN NULL WHEN max({x}) = min({x}) THEN 0.0 "
            f"ELSE skewness({x}) END")


def sql_stat(x: str, s: str) -> str:
    return {
        "mean": f"avg({x})", "max": f"max({x})", "min": f"min({x})",
        "sum": f"coalesce(sum({x}), 0.0)", "count": f"count({x})",
        "std": f"stddev_samp({x})", "skew": sql_skew(x),
    }[s]


def sql_stats(cols, stats, suffix="", src=None) -> list[tuple[str, str]]:
    out = []
    for c in cols:
        x = f'"{c}"' if src is None else src(c)
        for s in stats:
            out.append((f"{c}-{s}{suffix}", sql_stat(x, s)))
    return out


def _sel(pairs) -> str:
    return ",\n  ".join(f'{e} AS "{n}"' for n, e in pairs)


# ------------------------------------------------------------------ 2.1 scans

_reg("scan_transactions", W() + "SELECT * FROM txn")(
    lambda spark, sf: transactions(spark, sf))

# ------------------------------------------------------- 2.2 filters / project

_reg("year_month", W() + f"SELECT {KEYCOLS}, strftime(order_date, '%Y-%m') AS year_month FROM txn")(
    lambda spark, sf: _log(spark, sf).select(*LOG_ORDER[1:], year_month("order_date").alias("year_month")))

_reg("cut_before_month", W() + f"SELECT {KEYCOLS}, customer_id, total FROM txn WHERE order_date < {_ts(TARGET)}")(
    lambda spark, sf: _log(spark, sf).filter(before(TARGET)).select(*LOG_ORDER[1:], "customer_id", "total"))

_reg("month_slice", W() + f"SELECT {KEYCOLS}, customer_id, total FROM txn WHERE strftime(order_date, '%Y-%m') = '{TARGET}'")(
    lambda spark, sf: _log(spark, sf).filter(in_month(TARGET)).select(*LOG_ORDER[1:], "customer_id", "total"))

_reg("positive_rows", W() + f"SELECT {KEYCOLS}, customer_id, total FROM txn WHERE total > 0")(
    lambda spark, sf: _log(spark, sf).filter(F.col("total") > 0).select(*LOG_ORDER[1:], "customer_id", "total"))

_reg("manual_products", W() + f"SELECT {KEYCOLS}, product_id, description, total FROM txn WHERE product_id = 'M'")(
    lambda spark, sf: _log(spark, sf, description=True).filter(F.col("product_id") == "M")
    .select(*LOG_ORDER[1:], "product_id", "description", "total"))


def _customer_row_count(spark, sf):
    # The reference counts the rows of its busiest customer; here the
    # customer is chosen from the data (most rows, smallest id on ties).
    log = _log(spark, sf)
    c = log.groupBy("customer_id").agg(F.count("*").alias("rows"))
    return c.orderBy(F.desc("rows"), "customer_id").limit(1)


_reg("customer_row_count", W() + "SELECT customer_id, count(*) AS rows FROM txn GROUP BY customer_id "
     "ORDER BY rows DESC, customer_id LIMIT 1")(_customer_row_count)

_reg("nonnumeric_ids", W() + "SELECT product_id, count(*) AS rows FROM txn "
     "WHERE NOT regexp_full_match(product_id, '[0-9]+') GROUP BY product_id")(
    lambda spark, sf: _log(spark, sf).filter(~F.col("product_id").rlike("^[0-9]+$"))
    .groupBy("product_id").agg(F.count("*").alias("rows")))

_reg("exclude_cancelled", W() + f"SELECT {KEYCOLS}, order_id, total FROM txn WHERE NOT contains(order_id, 'C')")(
    lambda spark, sf: _log(spark, sf).filter(~F.col("order_id").contains("C"))
    .select(*LOG_ORDER[1:], "order_id", "total"))

# ----------------------------------------------------------------- labels (K1)

_reg("label_month", _fsql(W(
    f"cust AS (SELECT DISTINCT customer_id FROM txn WHERE strftime(order_date, '%Y-%m') < '{TARGET}')",
    f"g AS (SELECT customer_id, sum(total) AS total FROM txn WHERE strftime(order_date, '%Y-%m') = '{TARGET}' GROUP BY customer_id)")
    + f"SELECT c.customer_id, '{TARGET}' AS year_month, coalesce(g.total, 0.0) AS total, "
      f"CAST(coalesce(g.total, 0.0) > 300 AS INTEGER) AS label FROM cust c LEFT JOIN g USING (customer_id)", ["total"]))(
    lambda spark, sf: _fl(LB.label_month(_log(spark, sf), TARGET)))

_reg("monthly_spend", _fsql(W() + "SELECT customer_id, strftime(order_date, '%Y-%m') AS year_month, sum(total) AS total "
     "FROM txn GROUP BY 1, 2", ["total"]))(
    lambda spark, sf: _fl(LB.monthly_spend(_log(spark, sf))))

_reg("customers_before", W() + f"SELECT DISTINCT customer_id FROM txn WHERE order_date < {_ts(TARGET)}")(
    lambda spark, sf: LB.customers_before(_log(spark, sf), TARGET))

# -------------------------------------------------------- windows E1-E5, K10


def _cum_sql(key: str, tag: str) -> str:
    w = f"OVER (PARTITION BY {key} ORDER BY {ORD} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    cols = ", ".join(f'sum({v}) {w} AS "cumsum_{v}_by_{tag}"' for v in ["total", "quantity", "price"])
    inner = W() + f"SELECT {key}, {KEYCOLS}, {cols} FROM txn"
    return _fsql(inner, [f"cumsum_{v}_by_{tag}" for v in ["total", "quantity", "price"]])


def _cum_q(key):
    def run(spark, sf):
        out = RF.cumsum_by(_log(spark, sf), key)
        tag = RF.KEY_TAGS[key]
        outs = [f"cumsum_{v}_by_{tag}" for v in ["total", "quantity", "price"]]
        return _fl(out.select(key, *LOG_ORDER[1:], *outs), outs)
    return run


for _k, _t, _n in [("customer_id", "cust_id", "cumsum_by_customer"), ("product_id", "prod_id", "cumsum_by_product"),
                   ("order_id", "order_id", "cumsum_by_order")]:
    _reg(_n, _cum_sql(_k, _t))(_cum_q(_k))

_WC = f"OVER (PARTITION BY customer_id ORDER BY {ORD})"
_reg("diffs_by_customer", W(f"t AS (SELECT *, epoch(order_date) AS order_ts FROM txn)") +
     f"SELECT customer_id, {KEYCOLS}, order_ts, "
     f"order_ts - lag(order_ts) {_WC} AS order_ts_diff, quantity - lag(quantity) {_WC} AS quantity_diff, "
     f"price - lag(price) {_WC} AS price_diff, total - lag(total) {_WC} AS total_diff FROM t")(
    lambda spark, sf: RF.customer_scan(_log(spark, sf), with_cumsum=False)
    .select("customer_id", *LOG_ORDER[1:], "order_ts", "order_ts_diff", "quantity_diff", "price_diff", "total_diff"))

_reg("positive_gap", W(f"t AS (SELECT *, epoch(order_date) AS order_ts FROM txn)",
                       f"p AS (SELECT {KEYCOLS}, order_ts - lag(order_ts) {_WC} AS g FROM t WHERE total > 0)") +
     f"SELECT t.customer_id, {', '.join('t.' + k for k in KEYCOLS.split(', '))}, "
     f"CASE WHEN t.total > 0 THEN t.order_ts ELSE 0.0 END AS order_ts_plus, coalesce(p.g, 0.0) AS order_ts_plus_diff "
     f"FROM t LEFT JOIN p USING ({KEYCOLS})")(
    lambda spark, sf: RF.customer_scan(_log(spark, sf), with_cumsum=False)
    .select("customer_id", *LOG_ORDER[1:], "order_ts_plus", "order_ts_plus_diff"))

_reg("order_ts", W() + f"SELECT {KEYCOLS}, epoch(order_date) AS order_ts FROM txn")(
    lambda spark, sf: _log(spark, sf).select(*LOG_ORDER[1:], unix_seconds("order_date").alias("order_ts")))


def _order_ts_plus(spark, sf):
    rows = RF.customer_scan(_log(spark, sf).filter(before(TARGET)), with_cumsum=False)
    return _fl(rows.groupBy("customer_id").agg(
        *agg_columns([("order_ts_plus", ["first", "last"]), ("order_ts_plus_diff", STATS7)], FE.ROW_ORDER)))


def _first_last_sql(x: str, alias: str) -> list[tuple[str, str]]:
    return [(f"{alias}-first", f"arg_min({x}, ({ORD}))"), (f"{alias}-last", f"arg_max({x}, ({ORD}))")]


_reg("order_ts_plus", _fsql(W(
    f"t AS (SELECT *, epoch(order_date) AS order_ts FROM txn WHERE order_date < {_ts(TARGET)})",
    f"p AS (SELECT {KEYCOLS}, order_ts - lag(order_ts) {_WC} AS g FROM t WHERE total > 0)",
    f"r AS (SELECT t.*, CASE WHEN t.total > 0 THEN t.order_ts ELSE 0.0 END AS order_ts_plus, "
    f"coalesce(p.g, 0.0) AS order_ts_plus_diff FROM t LEFT JOIN p USING ({KEYCOLS}))") +
    "SELECT customer_id,\n  " + _sel(_first_last_sql("order_ts_plus", "order_ts_plus") +
                                     sql_stats(["order_ts_plus_diff"], STATS7)) + "\nFROM r GROUP BY customer_id",
    ["order_ts_plus-first", "order_ts_plus-last"] + [f"order_ts_plus_diff-{s}" for s in STATS7 if s != "count"]))(
    _order_ts_plus)

# ---------------------------------------------------------------- aggregates

_reg("customer_stats", _fsql(W() + "SELECT customer_id,\n  " + _sel(sql_stats(["quantity", "price", "total"], STATS7)) +
     f"\nFROM txn WHERE order_date < {_ts(TARGET)} GROUP BY customer_id",
     [f"{c}-{s}" for c in ["quantity", "price", "total"] for s in STATS7 if s != "count"]))(
    lambda spark, sf: _fl(_log(spark, sf).filter(before(TARGET)).groupBy("customer_id")
                          .agg(*agg_columns(FE.BASE_SPEC))))

_reg("nunique_per_customer", W() + 'SELECT customer_id, count(DISTINCT order_id) AS "order_id-nunique", '
     'count(DISTINCT product_id) AS "product_id-nunique" FROM txn GROUP BY customer_id')(
    lambda spark, sf: _log(spark, sf).groupBy("customer_id").agg(*agg_columns(FE.DISTINCT_SPEC)))

_reg("first_last_order_ts", W(f"t AS (SELECT *, epoch(order_date) AS order_ts FROM txn)") +
     "SELECT customer_id,\n  " + _sel(_first_last_sql("order_ts", "order_ts")) + "\nFROM t GROUP BY customer_id")(
    lambda spark, sf: RF.customer_scan(_log(spark, sf), with_cumsum=False).groupBy("customer_id")
    .agg(*agg_columns([("order_ts", ["first", "last"])], FE.ROW_ORDER)))


def _mode_sql(expr: str, alias: str, src: str = "txn") -> str:
    return (f"m_{alias.replace('-', '_')} AS (SELECT customer_id, v FROM (SELECT customer_id, v, row_number() OVER "
            f"(PARTITION BY customer_id ORDER BY n DESC, v ASC) AS rn FROM (SELECT customer_id, {expr} AS v, count(*) AS n "
            f"FROM {src} WHERE {expr} IS NOT NULL GROUP BY 1, 2) a) b WHERE rn = 1)")


_reg("month_mode", W(_mode_sql("month(order_date)", "month-mode"),
                     _mode_sql("strftime(order_date, '%Y-%m')", "year_month-mode")) +
     'SELECT a.customer_id, CAST(a.v AS INTEGER) AS "month-mode-mode", b.v AS "year_month-mode-mode" '
     "FROM m_month_mode a JOIN m_year_month_mode b USING (customer_id)")(
    lambda spark, sf: _log(spark, sf).groupBy("customer_id").agg(
        mode(F.month("order_date")).alias("month-mode-mode"),
        mode(year_month("order_date")).alias("year_month-mode-mode")))

_PIV = [ym_shift(TARGET, -12), ym_shift(TARGET, -24)]
_reg("month_pivot", _fsql(W() + "SELECT customer_id, " + ", ".join(
    f"coalesce(sum(CASE WHEN strftime(order_date, '%Y-%m') = '{m}' THEN total END), 0.0) AS \"{m}\"" for m in _PIV)
    + f" FROM txn WHERE order_date < {_ts(TARGET)} GROUP BY customer_id", _PIV))(
    lambda spark, sf: _fl(WN.month_pivot(_log(spark, sf).filter(before(TARGET)), _PIV)))

for _c in ["quantity", "total", "customer_id"]:
    _reg(f"hist_{_c}", W() + f"SELECT {_c}, count(*) AS count FROM txn GROUP BY {_c}")(
        (lambda c: lambda spark, sf: _log(spark, sf).groupBy(c).count().orderBy(c))(_c))

_reg("date_span", W() + "SELECT min(order_date) AS first_date, max(order_date) AS last_date, "
     "count(DISTINCT strftime(order_date, '%Y-%m')) AS months FROM txn")(
    lambda spark, sf: _log(spark, sf).agg(F.min("order_date").alias("first_date"),
                                          F.max("order_date").alias("last_date"),
                                          F.count_distinct(year_month("order_date")).alias("months")))


# ------------------------------------------------------- window builders K6-K9

_ANCH = [TRAIN, TARGET]


_reg("trend_features", SQ.trend_sql(_ANCH, season=False))(
    lambda spark, sf: _fl(WN.trend_features(_log(spark, sf), _ANCH)))
_reg("season_features", SQ.trend_sql(_ANCH, trend=False, season=True))(
    lambda spark, sf: _fl(WN.season_features(_log(spark, sf), _ANCH)))
_reg("season_features_compat", SQ.trend_sql(_ANCH, trend=False, season=True, compat=True))(
    lambda spark, sf: _fl(WN.season_features(_log(spark, sf), _ANCH, compat=True)))
_reg("cycle_1224", SQ.cycle_sql(_ANCH))(
    lambda spark, sf: _fl(WN.cycle_1224(_log(spark, sf), _ANCH)))

# ------------------------------------------------------------ builders K2-K5

_reg("fe_baseline", SQ.simple_sql(TARGET, [(c, STATS7) for c in ["quantity", "price", "total"]]))(
    lambda spark, sf: _fl(FE.fe_baseline(_log(spark, sf), TARGET).frame))
_reg("fe_cumulative", SQ.simple_sql(TARGET, [(c, STATS7) for c in ["quantity", "price", "total", *FE.CUMSUM_COLS]],
                                    cumsum=True, distinct=True))(
    lambda spark, sf: _fl(FE.fe_cumulative(_log(spark, sf), TARGET).frame))
_reg("fe_compact", SQ.simple_sql(TARGET, FE.COMPACT_SPEC, cycle=True))(
    lambda spark, sf: _fl(FE.fe_compact(_log(spark, sf), TARGET).frame))
_reg("fe_full", SQ.full_sql(TARGET))(
    lambda spark, sf: _fl(FE.fe_full(_log(spark, sf), TARGET).frame))
_reg("fe_full_compat", SQ.full_sql(TARGET, compat=True))(
    lambda spark, sf: _fl(FE.fe_full(_log(spark, sf), TARGET, compat=True).frame))


# ------------------------------------------------------------- metrics O1-O10
from cartcast.operators import metrics as MT  # noqa: E402


def _bin_scores(spark, sf) -> DataFrame:
    """Labels of the target month with two scores: the previous month's spend
    (a real baseline predictor, many ties at 0) and a fixed hash score in [0, 1)."""
    # labels and spend in one pass over the log, a row a customer, written once: every metric, fold and bound reads it instead
    return kept(LB.label_month(_log(spark, sf), TARGET, spend={"_ps": TRAIN})
                .select("customer_id", "label", F.coalesce("_ps", F.lit(0.0)).alias("score_prev"),
                        ((F.col("customer_id") * 7919) % 1000).cast("double").__truediv__(1000.0).alias("score")), "scores")


_BIN = (
    f"lab1 AS (SELECT c.customer_id, CAST(coalesce(g.t, 0.0) > 300 AS INTEGER) AS label "
    f"FROM (SELECT DISTINCT customer_id FROM txn WHERE order_date < {_ts(TARGET)}) c LEFT JOIN "
    f"(SELECT customer_id, sum(total) AS t FROM txn WHERE strftime(order_date, '%Y-%m') = '{TARGET}' GROUP BY 1) g "
    f"USING (customer_id))",
    f"bs AS (SELECT l.customer_id, l.label, coalesce(p.t, 0.0) AS score_prev, "
    f"CAST((l.customer_id * 7919) % 1000 AS DOUBLE) / 1000 AS score FROM lab1 l LEFT JOIN "
    f"(SELECT customer_id, sum(total) AS t FROM txn WHERE strftime(order_date, '%Y-%m') = '{TRAIN}' GROUP BY 1) p "
    f"USING (customer_id))",
)


def _auc_sql(src: str, score: str, label: str = "label", by: str | None = None) -> str:
    k = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    return (f"SELECT {k}CASE WHEN sum(p) > 0 AND sum(n) > 0 THEN sum(p * (coalesce(nb, 0) + 0.5 * n)) / (sum(p) * sum(n)) END AS auc "
            f"FROM (SELECT *, sum(n) OVER ({part}ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS nb FROM "
            f"(SELECT {k}CAST({score} AS DOUBLE) AS s, sum({label}) AS p, sum(1 - {label}) AS n FROM {src} GROUP BY {k}s) a) b"
            + (f" GROUP BY {by}" if by else ""))


_reg("roc_auc", _fsql(W(*_BIN) + _auc_sql("bs", "score_prev"), ["auc"]))(
    lambda spark, sf: _fl(MT.roc_auc(_bin_scores(spark, sf), "label", "score_prev")))
_reg("metric_gini", _fsql(W(*_BIN) + f"SELECT greatest(2 * auc - 1, 0.0) AS gini FROM ({_auc_sql('bs', 'score_prev')}) a",
                          ["gini"]))(
    lambda spark, sf: _fl(MT.gini(_bin_scores(spark, sf), "label", "score_prev")))
_reg("metric_custom_2auc", _fsql(W(*_BIN) + f"SELECT 2 * auc AS value FROM ({_auc_sql('bs', 'score')}) a", ["value"]))(
    lambda spark, sf: _fl(MT.custom_2auc().fn(_bin_scores(spark, sf), "label", "score")))

_reg("threshold_metrics", _fsql(W(*_BIN, "c AS (SELECT sum(CASE WHEN score > 0.5 AND label = 1 THEN 1 ELSE 0 END) AS tp, "
     "sum(CASE WHEN score > 0.5 AND label = 0 THEN 1 ELSE 0 END) AS fp, sum(CASE WHEN score <= 0.5 AND label = 1 THEN 1 ELSE 0 END) AS fn, "
     "sum(CASE WHEN score <= 0.5 AND label = 0 THEN 1 ELSE 0 END) AS tn FROM bs)") +
     "SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn, "
     "(tp + tn) / (tp + fp + fn + tn) AS accuracy, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision, "
     "CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall, "
     "CASE WHEN tp > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1 FROM c",
     ["accuracy", "precision", "recall", "f1"]))(
    lambda spark, sf: _fl(MT.threshold_metrics(_bin_scores(spark, sf)).select(
        *[F.col(c).cast("long") for c in ["tp", "fp", "fn", "tn"]], "accuracy", "precision", "recall", "f1")))

_ALL_METRICS = ["auc", "accuracy", "balanced_accuracy", "logloss", "mse", "rmse", "mae", "rmsle", "gini"]


def _metric_table(spark, sf):
    """All metrics for two eval sets, each the mean over two tasks (score and its mirror)."""
    s = _bin_scores(spark, sf).withColumn("eval_set", F.when(F.col("customer_id") % 5 == 0, "valid").otherwise("train"))
    two = s.withColumn("task", F.lit("a")).unionByName(s.withColumn("task", F.lit("b")).withColumn("score", 1.0 - F.col("score")))
    return _fl(MT.metric_table(two, _ALL_METRICS, task_col="task"))


def _metric_table_sql() -> str:
    clip = "least(greatest(score, 1e-15), 1 - 1e-15)"
    hit = "CASE WHEN (score > 0.5) = (label = 1) THEN 1.0 ELSE 0.0 END"
    auc = f"SELECT split_part(st, '/', 1) AS eval_set, split_part(st, '/', 2) AS task, auc FROM ({_auc_sql('ev', 'score', by='st')}) a"
    one = {
        "accuracy": f"avg({hit})", "logloss": f"-avg(ln(CASE WHEN label = 1 THEN {clip} ELSE 1 - {clip} END))",
        "mse": "avg((score - label) * (score - label))", "rmse": "sqrt(avg((score - label) * (score - label)))",
        "mae": "avg(abs(score - label))",
        "rmsle": "avg((ln(1 + greatest(score, 0.0)) - ln(1 + label)) * (ln(1 + greatest(score, 0.0)) - ln(1 + label)))"}
    each = [f"SELECT eval_set, task, '{n}' AS m, {e} AS v FROM ev GROUP BY 1, 2" for n, e in one.items()]
    each += [f"SELECT eval_set, task, 'auc', auc FROM ({auc}) x", f"SELECT eval_set, task, 'gini', greatest(2 * auc - 1, 0.0) FROM ({auc}) x",
             f"SELECT eval_set, task, 'balanced_accuracy', avg(r) FROM (SELECT eval_set, task, label, avg({hit}) AS r FROM ev GROUP BY 1, 2, 3) x GROUP BY 1, 2"]
    ev = ("ev AS (SELECT *, eval_set || '/' || task AS st FROM (SELECT customer_id, label, CASE WHEN customer_id % 5 = 0 THEN 'valid' ELSE 'train' END AS eval_set, "
          "'a' AS task, score FROM bs UNION ALL SELECT customer_id, label, CASE WHEN customer_id % 5 = 0 THEN 'valid' ELSE 'train' END, 'b', 1.0 - score FROM bs) u)")
    return W(*_BIN, ev) + f"SELECT eval_set, eval_set || '_' || m AS metric, avg(v) AS value FROM ({' UNION ALL '.join(each)}) z GROUP BY 1, 2"


_reg("metric_table", _fsql(_metric_table_sql(), ["value"]))(_metric_table)


# multi-class: a class's logit is the product of the whole vector with the mean vector of the class, rounded
# so that both engines see the same ties
def _mc(spark, sf) -> DataFrame:
    e = read_table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))
    long = e.select("label", F.posexplode("x").alias("i", "v"))
    means = long.groupBy("label", "i").agg(F.avg("v").alias("m")).collect()  # classes x dimensions
    by: dict = {}
    for r in means:
        by.setdefault(r["label"], {})[r["i"]] = r["m"]
    logits = F.array(*[F.round(F.aggregate(F.zip_with("x", F.array(*[F.lit(by[c][i]) for i in sorted(by[c])]), lambda a, b: a * b),
                                           F.lit(0.0), lambda s, v: s + v), 9) for c in sorted(by)])
    return (e.select("vec_id", "label", logits.alias("z")).select("vec_id", "label", "z", MT.softmax(F.col("z")).alias("proba"))
             .withColumn("pred", MT.argmax(F.col("z"))).drop("z"))


_MC = ("v AS (SELECT vec_id, label, unnest(range(0, len(embedding))) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)",
       "mean AS (SELECT label AS class, i, avg(x) AS m FROM v GROUP BY 1, 2)",
       "e AS (SELECT vec_id, label, class, round(sum(x * m), 9) AS z FROM v JOIN mean USING (i) GROUP BY 1, 2, 3)",
       "m AS (SELECT vec_id, max(z) AS mz FROM e GROUP BY vec_id)",
       "x AS (SELECT e.vec_id, e.label, e.class, exp(e.z - m.mz) AS ez FROM e JOIN m USING (vec_id))",
       "pr AS (SELECT vec_id, label, class, ez / sum(ez) OVER (PARTITION BY vec_id) AS proba FROM x)",
       "am AS (SELECT vec_id, label, CAST(first(class ORDER BY z DESC, class) AS INTEGER) AS pred FROM e GROUP BY vec_id, label)")

_reg("softmax_scores", _fsql("WITH " + ",\n".join(_MC[:6]) + " SELECT vec_id, CAST(class AS INTEGER) AS class, proba FROM pr",
                             ["proba"]))(
    lambda spark, sf: _fl(_mc(spark, sf).select("vec_id", F.posexplode("proba").alias("class", "proba"))))
_reg("argmax_class", "WITH " + ",\n".join(_MC) + " SELECT vec_id, label, pred FROM am")(
    lambda spark, sf: _mc(spark, sf).select("vec_id", "label", "pred"))
_reg("metric_accuracy", _fsql("WITH " + ",\n".join(_MC) + " SELECT avg(CASE WHEN pred = label THEN 1.0 ELSE 0.0 END) AS accuracy FROM am",
                              ["accuracy"]))(
    lambda spark, sf: _fl(MT.accuracy(_mc(spark, sf))))
_reg("metric_balanced_accuracy", _fsql("WITH " + ",\n".join(_MC) + " SELECT avg(r) AS balanced_accuracy FROM "
     "(SELECT label, avg(CASE WHEN pred = label THEN 1.0 ELSE 0.0 END) AS r FROM am GROUP BY label) a", ["balanced_accuracy"]))(
    lambda spark, sf: _fl(MT.balanced_accuracy(_mc(spark, sf))))
_reg("metric_logloss", _fsql("WITH " + ",\n".join(_MC[:6]) + ", cl AS (SELECT vec_id, label, class, "
     "least(greatest(proba, 1e-15), 1 - 1e-15) AS q FROM pr) SELECT -avg(ln(q / s)) AS logloss FROM "
     "(SELECT vec_id, label, class, q, sum(q) OVER (PARTITION BY vec_id) AS s FROM cl) a WHERE class = label",
     ["logloss"]))(
    lambda spark, sf: _fl(MT.log_loss(_mc(spark, sf))))


def _decode(spark, sf):
    # Class id -> name through a dictionary table derived from the data
    # (nation names keyed by nation key).
    names = read_table(spark, sf, "nation").select(F.col("n_nationkey").alias("pred"), F.col("n_name").alias("pred_name"))
    return _mc(spark, sf).join(names, "pred", "left").select("vec_id", "pred", "pred_name")


_reg("decode_predictions", "WITH " + ",\n".join(_MC) +
     " SELECT am.vec_id, am.pred, n.n_name AS pred_name FROM am LEFT JOIN nation n ON am.pred = n.n_nationkey")(_decode)


def _reg_scores(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    pt = read_table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return li.join(pt, li.l_partkey == pt.p_partkey).select(
        F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * F.col("p_retailprice")).alias("pred"))


_RG = "rg AS (SELECT l.l_extendedprice AS y, l.l_quantity * p.p_retailprice AS pred FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"
_reg("metric_mae", _fsql(f"WITH {_RG} SELECT avg(abs(pred - y)) AS mae FROM rg", ["mae"]))(
    lambda spark, sf: _fl(MT.regression_metrics(_reg_scores(spark, sf)).select("mae")))
_reg("metric_mse_rmse", _fsql(f"WITH {_RG} SELECT avg((pred - y) * (pred - y)) AS mse, sqrt(avg((pred - y) * (pred - y))) AS rmse FROM rg",
                              ["mse", "rmse"]))(
    lambda spark, sf: _fl(MT.regression_metrics(_reg_scores(spark, sf)).select("mse", "rmse")))
_reg("metric_rmsle", _fsql(f"WITH {_RG}, le AS (SELECT ln(1 + greatest(pred, 0.0)) - ln(1 + y) AS d FROM rg) "
                           f"SELECT avg(d * d) AS rmsle, sqrt(avg(d * d)) AS rmsle_root FROM le",
                           ["rmsle", "rmsle_root"]))(
    lambda spark, sf: _fl(MT.regression_metrics(_reg_scores(spark, sf)).select("rmsle", "rmsle_root")))


def _masked(spark, sf):
    e = read_table(spark, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("col", "x"))
    e = e.withColumn("x", F.col("x").cast("double")).withColumn(
        "mask", (((F.col("vec_id") * 7919 + F.col("col") * 104729) % 10) < 2).cast("int"))
    mean = e.groupBy("col").agg(F.avg("x").alias("pred"))
    return _fl(MT.masked_reconstruction(e.join(mean, "col"), row="vec_id"))


_reg("metric_masked_reconstruction", _fsql(
    "WITH e AS (SELECT vec_id, i - 1 AS col, CAST(embedding[i] AS DOUBLE) AS x, "
    "CASE WHEN (vec_id * 7919 + (i - 1) * 104729) % 10 < 2 THEN 1 ELSE 0 END AS mask FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) t), "
    "s AS (SELECT col, avg(x) AS pred, var_samp(x) AS v FROM e GROUP BY col), "
    "r AS (SELECT e.vec_id, sum(e.mask * (s.pred - e.x) * (s.pred - e.x) / (coalesce(s.v, CAST(0 AS DOUBLE)) + CAST(1e-9 AS DOUBLE))) AS l, "
    "CAST(sum(e.mask) AS DOUBLE) AS m FROM e JOIN s USING (col) GROUP BY e.vec_id) "
    "SELECT avg(l / (m + CAST(1e-9 AS DOUBLE))) AS unsup_loss FROM r", ["unsup_loss"]))(_masked)


# ----------------------------------------------------------- sources / sinks
from cartcast.operators import prep as PR  # noqa: E402
from cartcast.operators import profile as PF  # noqa: E402
from cartcast.operators import report as RP  # noqa: E402
from cartcast.operators import split as SP  # noqa: E402
from cartcast.sources import files as IO  # noqa: E402

_CUST_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _headerless(spark, sf):
    # A2 + A8: write the customer table as headerless gzip CSV, other files beside
    # them in the same folder, then read back only the files picked by a name pattern.
    base = IO.scratch_path(spark, "headerless")
    cust = read_table(spark, sf, "customer").select(*_CUST_COLS)
    IO.write_csv(cust, base, header=False, compression="gzip")
    read_table(spark, sf, "nation").write.mode("append").option("header", False).csv(base)
    return IO.read_headerless_csv(spark, base, _CUST_COLS,
                                  [T.LongType(), T.StringType(), T.IntegerType(), T.DoubleType(), T.StringType()],
                                  glob="*.csv.gz")


_reg("scan_headerless_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")(_headerless)


def _csv_roundtrip(spark, sf):
    # A5 then A1: the log written as header CSV and read back with its schema.
    path = IO.scratch_path(spark, "log")
    log = transactions(spark, sf).select(*[f.name for f in IO.LOG_SCHEMA.fields])
    IO.write_csv(log, path)
    return IO.read_log_csv(spark, path)


_reg("sink_csv_roundtrip", W() + "SELECT order_id, product_id, description, quantity, order_date, price, customer_id, "
     "country, total FROM txn")(_csv_roundtrip)


def _feature_list(spark, sf):
    fs = FE.fe_full(_log(spark, sf), TARGET)
    names = IO.write_feature_list(spark, fs.features, IO.scratch_path(spark, "features"))
    counts = fs.frame.agg(*[F.count(f"`{c}`").alias(c) for c in fs.features])
    counts = counts.unpivot([], [F.col(f"`{c}`") for c in fs.features], "feature", "non_null")
    return names.join(counts, "feature")


_reg("feature_list", "WITH f AS (" + SQ.full_sql(TARGET) + "), c AS (SELECT " + ", ".join(
    f'count("{c}") AS "{c}"' for c in FE.full_feature_names()) + " FROM f), n AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{c}')" for i, c in enumerate(FE.full_feature_names())) + ") t(position, feature)), u AS (UNPIVOT c ON COLUMNS(*) INTO NAME feature VALUE non_null) "
    "SELECT CAST(position AS INTEGER) AS position, feature, non_null FROM n JOIN u USING (feature)")(_feature_list)


_RAW = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def _full_from_csv(spark, sf):
    # the builder on a plain log file: the caller names the columns that order its rows
    path = IO.scratch_path(spark, "plain-log")
    own = [F.col(c).alias(f"line_{k}") for k, c in enumerate(_RAW)]
    log = transactions(spark, sf).select(*[f.name for f in IO.LOG_SCHEMA.fields], *own)
    with cleaned(spark):
        IO.write_csv(log, path, compression="gzip")
    read = IO.read_log_csv(spark, path, log.schema)
    return _fl(FE.fe_full(read, TARGET, order=["order_date", *[f"line_{k}" for k in range(len(_RAW))]]).frame)


_reg("fe_full_from_csv", SQ.full_sql(TARGET))(_full_from_csv)


def _fold_preds(spark, sf) -> DataFrame:
    """Fixed per-fold predictions for the target-month customers (5 folds)."""
    lab = LB.label_month(_log(spark, sf), TARGET).select("customer_id", "label")
    f = lab.select("customer_id", "label", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("fold"))
    return f.withColumn("p", (((F.col("customer_id") * 7919 + F.col("fold") * 104729) % 1000).cast("double") + 0.5) / 1000.0)


_FP = _BIN[:1] + ("fp AS (SELECT l.customer_id, l.label, CAST(f.fold AS INTEGER) AS fold, "
                  "(CAST((l.customer_id * 7919 + f.fold * 104729) % 1000 AS DOUBLE) + 0.5) / 1000 AS p "
                  "FROM lab1 l, range(0, 5) f(fold))",)

_reg("submission", _fsql(W(*_FP) + "SELECT l.customer_id, a.probability FROM lab1 l LEFT JOIN "
     "(SELECT customer_id, avg(p) AS probability FROM fp GROUP BY 1) a USING (customer_id)", ["probability"]))(
    lambda spark, sf: _fl(IO.submission(LB.label_month(_log(spark, sf), TARGET),
                                        RP.fold_average(_fold_preds(spark, sf), "customer_id"))))
_reg("fold_average", _fsql(W(*_FP) + "SELECT customer_id, avg(p) AS probability FROM fp GROUP BY 1", ["probability"]))(
    lambda spark, sf: _fl(RP.fold_average(_fold_preds(spark, sf), "customer_id")))
_reg("fold_geomean", _fsql(W(*_FP) + f"SELECT customer_id, exp(avg(ln(p + CAST('{RP.EPS!r}' AS DOUBLE)))) AS probability "
                           "FROM fp GROUP BY 1", ["probability"]))(
    lambda spark, sf: _fl(RP.fold_geomean(_fold_preds(spark, sf), "customer_id")))

# ------------------------------------------------------ projections, B11-B19

_BASE_SPEC = [(c, STATS7) for c in ["quantity", "price", "total"]]
_reg("feature_columns", f"SELECT * EXCLUDE (customer_id, year_month, label) FROM ({SQ.simple_sql(TARGET, _BASE_SPEC)}) b")(
    lambda spark, sf: _fl(FE.fe_baseline(_log(spark, sf), TARGET).frame.drop("customer_id", "year_month", "label")))

_PICK = FE.picked_names()
_reg("picked_features", "SELECT customer_id, year_month, " + ", ".join(f'"{c}"' for c in _PICK) +
     f" FROM ({SQ.full_sql(TARGET)}) f")(
    lambda spark, sf: _fl(FE.fe_full(_log(spark, sf), TARGET).frame.select(
        "customer_id", "year_month", *[F.col(f"`{c}`") for c in _PICK])))

_reg("relabel_target", "SELECT doc_id, CASE WHEN quality = 0 THEN 'wealthy' ELSE CAST(quality AS VARCHAR) END AS quality FROM labels")(
    lambda spark, sf: read_table(spark, sf, "labels").select(
        "doc_id", F.when(F.col("quality") == 0, "wealthy").otherwise(F.col("quality").cast("string")).alias("quality")))

_FILL_COLS = [f"{c}-{s}" for c in ["quantity", "price", "total"] for s in STATS7]
_reg("fill_constants", _fsql(
    "SELECT customer_id, year_month, label, " + ", ".join(
        f'coalesce("{c}", 0{".0" if not c.endswith("-count") else ""}) AS "{c}"' for c in _FILL_COLS) +
    f" FROM ({SQ.simple_sql(TARGET, _BASE_SPEC, impute=False, normalize=False)}) b",
    [c for c in _FILL_COLS if not c.endswith("-count")]))(
    lambda spark, sf: _fl(PR.fill_constants(FE.fe_baseline(_log(spark, sf), TARGET, impute=False).frame)))

def _columns_by_type(spark, sf):
    li = read_table(spark, sf, "lineitem")
    cols = SP.columns_of_type(li, [T.DoubleType])
    return li.agg(*[F.count(c).alias(c) for c in cols]).unpivot([], cols, "column", "non_null")


_reg("columns_by_type", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS non_null FROM lineitem"
                                            for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))(_columns_by_type)

_reg("multi_target", "SELECT doc_id, quality, quality AS quality_0, quality AS quality_1, quality AS quality_2 FROM labels")(
    lambda spark, sf: PR.multi_target(read_table(spark, sf, "labels").select("doc_id", "quality"), "quality", 3))
_reg("random_target", "SELECT doc_id, CAST(10 + floor(CAST('0x' || substr(md5(doc_id || ':0'), 1, 7) AS BIGINT) / 268435456.0::DOUBLE * 5) AS INTEGER) AS rand_target FROM labels")(
    lambda spark, sf: PR.random_int_target(read_table(spark, sf, "labels").select("doc_id"), "doc_id", 10, 15, seed=0))

# -------------------------------------------------------------------- joins


def _join_blocks(spark, sf):
    log = _log(spark, sf).filter(before(TARGET))
    a = log.groupBy("customer_id").agg(*agg_columns(FE.BASE_SPEC))
    b = log.groupBy("customer_id").agg(*agg_columns(FE.DISTINCT_SPEC))
    return _fl(a.join(b, "customer_id", "left"))


_reg("join_feature_blocks", _fsql(W(
    f"a AS (SELECT customer_id, {_sel(sql_stats(['quantity', 'price', 'total'], STATS7))} FROM txn "
    f"WHERE order_date < {_ts(TARGET)} GROUP BY 1)",
    f"b AS (SELECT customer_id, count(DISTINCT order_id) AS \"order_id-nunique\", count(DISTINCT product_id) AS "
    f"\"product_id-nunique\" FROM txn WHERE order_date < {_ts(TARGET)} GROUP BY 1)") +
    "SELECT * FROM a LEFT JOIN b USING (customer_id)",
    [f"{c}-{s}" for c in ["quantity", "price", "total"] for s in STATS7 if s != "count"]))(_join_blocks)

_DESC_SQL = (f"SELECT customer_id, string_agg(description, ', ' ORDER BY {ORD}) AS description FROM txn "
             f"WHERE order_date < {_ts(TARGET)} GROUP BY customer_id")
_reg("customer_descriptions", W() + _DESC_SQL)(
    lambda spark, sf: FE.customer_descriptions(_log(spark, sf, description=True), TARGET))
_reg("features_with_text", f"WITH f AS ({SQ.simple_sql(TARGET, FE.COMPACT_SPEC, cycle=True)}) " + " UNION ALL ".join(
    f"SELECT f.*, d.description FROM f LEFT JOIN ({W() + _DESC_SQL.replace(_ts(TARGET), _ts(m))}) d USING (customer_id) "
    f"WHERE f.year_month = '{m}'" for m in (TRAIN, TARGET)))(
    lambda spark, sf: _fl(FE.features_with_text(FE.fe_compact(_log(spark, sf), TARGET), _log(spark, sf, description=True))))

_reg("unseen_labels", W() + f"SELECT DISTINCT product_id FROM txn WHERE strftime(order_date, '%Y-%m') = '{TARGET}' "
     f"AND product_id NOT IN (SELECT product_id FROM txn WHERE order_date < {_ts(TARGET)})")(
    lambda spark, sf: PR.unseen_labels(_log(spark, sf).filter(before(TARGET)), _log(spark, sf).filter(in_month(TARGET)),
                                       "product_id"))


def _one_row(*frames: DataFrame) -> DataFrame:
    """One-row results side by side, as one aggregate over their union."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.agg(*[F.max(c).alias(c) for c in out.columns])


def _eval_join(spark, sf):
    # Ground truth and predictions paired on the key (never by position)
    gt = LB.label_month(_log(spark, sf), TARGET).select("customer_id", "label")
    pr = _bin_scores(spark, sf).select("customer_id", F.col("score").alias("probability"))
    j = gt.join(pr, "customer_id")
    return _fl(_one_row(MT.roc_auc(j, "label", "probability"), j.agg(F.count("*").alias("rows"))))


_reg("eval_join", _fsql(W(*_BIN) + f"SELECT a.auc, c.rows FROM ({_auc_sql('bs', 'score')}) a, "
                        "(SELECT count(*) AS rows FROM bs) c", ["auc"]))(_eval_join)



def _eval_csv(spark, sf):
    # A3: ground truth and predictions from two CSV files, paired on the key
    gt = IO.write_csv(LB.label_month(_log(spark, sf), TARGET).select("customer_id", "label"), IO.scratch_path(spark, "label"))
    pr = IO.write_csv(_bin_scores(spark, sf).select("customer_id", F.col("score").alias("probability")), IO.scratch_path(spark, "predictions"))
    gt = IO.read_value_csv(spark, gt, "customer_id", "label", T.IntegerType())
    j = gt.join(IO.read_value_csv(spark, pr, "customer_id", "probability", T.DoubleType()), "customer_id")
    return _fl(_one_row(MT.roc_auc(j, "label", "probability"), j.agg(F.count("*").alias("rows"), F.sum("label").alias("positive"))))


_reg("eval_csv", _fsql(W(*_BIN) + f"SELECT a.auc, c.rows, c.positive FROM ({_auc_sql('bs', 'score')}) a, "
                       "(SELECT count(*) AS rows, CAST(sum(label) AS BIGINT) AS positive FROM bs) c", ["auc"]))(_eval_csv)

_reg("calendar_grid", W() + "SELECT c.customer_id, strftime(m.d, '%Y-%m') AS year_month FROM (SELECT DISTINCT customer_id FROM txn) c, "
     "(SELECT unnest(generate_series(date_trunc('month', min(order_date)), date_trunc('month', max(order_date)), "
     "INTERVAL 1 MONTH)) AS d FROM txn) m")(
    lambda spark, sf: WN.calendar_grid(_log(spark, sf)))
_reg("calendar_days", W() + "SELECT strftime(d, '%Y-%m') AS year_month, count(*) AS days FROM (SELECT unnest(generate_series("
     "CAST(min(order_date) AS DATE), CAST(max(order_date) AS DATE), INTERVAL 1 DAY)) AS d FROM txn) x GROUP BY 1")(
    lambda spark, sf: WN.calendar_days(_log(spark, sf)))
_reg("monthly_dense", _fsql(W() + f"SELECT c.customer_id, '{ym_shift(TARGET, -12)}' AS year_month, coalesce(g.t, 0.0) AS total "
     f"FROM (SELECT DISTINCT customer_id FROM txn WHERE order_date < {_ts(TARGET)}) c LEFT JOIN (SELECT customer_id, sum(total) AS t "
     f"FROM txn WHERE strftime(order_date, '%Y-%m') = '{ym_shift(TARGET, -12)}' GROUP BY 1) g USING (customer_id)", ["total"]))(
    lambda spark, sf: _fl(WN.monthly_dense(_log(spark, sf).filter(before(TARGET)), ym_shift(TARGET, -12))))

# --------------------------------------------------------------- aggregates

_SPEC_D3 = [("quantity", ["mean", "max"]), ("total", ["sum", "count"]), ("order_id", ["nunique"])]
_reg("agg_spec", _fsql(W() + 'SELECT customer_id, avg(quantity) AS "quantity-mean", max(quantity) AS "quantity-max", '
     'coalesce(sum(total), 0.0) AS "total-sum", count(total) AS "total-count", count(DISTINCT order_id) AS "order_id-nunique" '
     "FROM txn GROUP BY 1", ["quantity-mean", "quantity-max", "total-sum"]))(
    lambda spark, sf: _fl(_log(spark, sf).groupBy("customer_id").agg(*agg_columns(_SPEC_D3))))
_reg("agg_spec_custom", _fsql(W() + 'SELECT customer_id, max(total) - min(total) AS "total-mode", avg(price) AS "price-mean" '
     "FROM txn GROUP BY 1", ["total-mode", "price-mean"]))(
    lambda spark, sf: _fl(_log(spark, sf).groupBy("customer_id").agg(
        *agg_columns([("total", [lambda c: F.max(c) - F.min(c)]), ("price", ["mean"])]))))

_DESC_COLS = ["quantity", "price", "total"]
_reg("describe_numeric", _fsql(W() + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, "
    f"quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75, max({c}) AS max FROM txn"
    for c in _DESC_COLS), ["mean", "std", "min", "p25", "p50", "p75", "max"]))(
    lambda spark, sf: _fl(PF.describe_numeric(_log(spark, sf), _DESC_COLS)))
_reg("column_cardinality", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS nunique FROM customer" for c in _CUST_COLS))(
    lambda spark, sf: PF.column_cardinality(read_table(spark, sf, "customer").select(*_CUST_COLS)))
_reg("categorical_columns", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS nunique, "
    f"({'TRUE' if t == 'VARCHAR' else 'FALSE'} OR count(DISTINCT {c}) < 200) AS categorical FROM customer"
    for c, t in zip(_CUST_COLS, ["BIGINT", "VARCHAR", "INTEGER", "DOUBLE", "VARCHAR"])))(
    lambda spark, sf: PF.categorical_columns(read_table(spark, sf, "customer").select(*_CUST_COLS)))
_reg("class_counts", "SELECT label, count(*) AS count FROM embeddings GROUP BY 1")(
    lambda spark, sf: PF.class_counts(read_table(spark, sf, "embeddings"), "label"))
_reg("id_patterns", W() + "SELECT regexp_replace(product_id, '[0-9]', '_', 'g') AS pattern, count(*) AS rows, "
     "count(DISTINCT product_id) AS ids, NOT regexp_full_match(regexp_replace(product_id, '[0-9]', '_', 'g'), '_+') AS nonnumeric "
     "FROM txn GROUP BY 1")(
    lambda spark, sf: PF.id_patterns(_log(spark, sf), "product_id"))
_reg("target_type", "SELECT 'quality' AS target, CASE WHEN max(CASE WHEN quality <> floor(quality) THEN 1 ELSE 0 END) = 1 "
     "THEN 'continuous' WHEN count(DISTINCT quality) <= 2 THEN 'binary' ELSE 'multiclass' END AS target_type FROM labels "
     "UNION ALL SELECT 'label', CASE WHEN count(DISTINCT label) <= 2 THEN 'binary' ELSE 'multiclass' END FROM embeddings "
     "UNION ALL SELECT 'l_extendedprice', CASE WHEN max(CASE WHEN l_extendedprice <> floor(l_extendedprice) THEN 1 ELSE 0 END) = 1 "
     "THEN 'continuous' ELSE 'multiclass' END FROM lineitem "
     "UNION ALL SELECT 'quality,toxic', CASE WHEN count(*) FILTER (WHERE v NOT IN (0, 1)) = 0 AND count(DISTINCT v) = 2 THEN 'multilabel-indicator' "
     "ELSE 'multiclass-multioutput' END FROM (SELECT quality AS v FROM labels UNION ALL SELECT toxic FROM labels) u "
     "UNION ALL SELECT 'quality,label', CASE WHEN count(*) FILTER (WHERE v NOT IN (0, 1)) = 0 AND count(DISTINCT v) = 2 THEN 'multilabel-indicator' "
     "ELSE 'multiclass-multioutput' END FROM (SELECT quality AS v FROM labels JOIN embeddings ON doc_id = vec_id UNION ALL "
     "SELECT label FROM labels JOIN embeddings ON doc_id = vec_id) u "
     "UNION ALL SELECT 'l_quantity,l_discount', CASE WHEN max(CASE WHEN v <> floor(v) THEN 1 ELSE 0 END) = 1 THEN 'continuous-multioutput' "
     "ELSE 'multiclass-multioutput' END FROM (SELECT l_quantity AS v FROM lineitem UNION ALL SELECT l_discount FROM lineitem) u "
     "UNION ALL SELECT 'l_returnflag', CASE WHEN count(DISTINCT l_returnflag) <= 2 THEN 'binary' ELSE 'multiclass' END FROM lineitem "
     "UNION ALL SELECT 'half', CASE WHEN count(DISTINCT CASE WHEN l_linenumber % 2 = 0 THEN 'even' ELSE 'odd' END) <= 2 THEN 'binary' ELSE 'multiclass' END FROM lineitem")(
    lambda spark, sf: PF.target_type(read_table(spark, sf, "labels"), ["quality"])
    .unionByName(PF.target_type(read_table(spark, sf, "embeddings"), ["label"]))
    .unionByName(PF.target_type(read_table(spark, sf, "lineitem"), ["l_extendedprice"]))
    .unionByName(PF.target_type(read_table(spark, sf, "labels"), ["quality", "toxic"]))
    .unionByName(PF.target_type(read_table(spark, sf, "labels").join(read_table(spark, sf, "embeddings").withColumnRenamed("vec_id", "doc_id"), "doc_id"), ["quality", "label"]))
    .unionByName(PF.target_type(read_table(spark, sf, "lineitem"), ["l_quantity", "l_discount"]))
    .unionByName(PF.target_type(read_table(spark, sf, "lineitem"), ["l_returnflag"]))
    .unionByName(PF.target_type(read_table(spark, sf, "lineitem").select(F.when(F.col("l_linenumber") % 2 == 0, "even").otherwise("odd").alias("half")), ["half"])))
_reg("nonfinite_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls, count(*) FILTER (WHERE isnan({c})) AS nans, "
    f"count(*) FILTER (WHERE isinf({c})) AS infs FROM lineitem" for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))(
    lambda spark, sf: PF.nonfinite_counts(read_table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice",
                                                                                    "l_discount", "l_tax")))
_reg("target_type_mix", W() + "SELECT count(*) FILTER (WHERE TRY_CAST(product_id AS DOUBLE) IS NOT NULL) AS numeric, "
     "count(*) FILTER (WHERE TRY_CAST(product_id AS DOUBLE) IS NULL AND product_id IS NOT NULL) AS non_numeric, "
     "(count(*) FILTER (WHERE TRY_CAST(product_id AS DOUBLE) IS NOT NULL) > 0 AND count(*) FILTER (WHERE "
     "TRY_CAST(product_id AS DOUBLE) IS NULL AND product_id IS NOT NULL) > 0) AS mixed FROM txn")(
    lambda spark, sf: PF.target_type_mix(_log(spark, sf), "product_id"))
_ORD_TYPES = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
              ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]
_reg("table_info", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count({c}) AS non_null, count(*) AS rows FROM orders" for c, t in _ORD_TYPES))(
    lambda spark, sf: PF.table_info(read_table(spark, sf, "orders")))


def _schema_check(spark, sf):
    fs = FE.fe_baseline(_log(spark, sf), TARGET)
    return PF.schema_check(fs.train, {"valid": fs.test, "test_no_label": fs.test.drop("label")}, fs.features, ["label"])


_N = f"(SELECT count(*) FROM ({SQ.simple_sql(TARGET, _BASE_SPEC, normalize=False)}) b WHERE year_month = '{TARGET}')"
_reg("schema_check", "SELECT * FROM (VALUES " + ", ".join(
    f"('{s}', 'features_present', TRUE, ''), ('{s}', 'feature_types', TRUE, ''), ('{s}', 'target_count', {ok}, '{n}')"
    for s, ok, n in (("valid", "TRUE", 1), ("test_no_label", "FALSE", 0))) + ") t(eval_set, \"check\", ok, detail) "
    f"UNION ALL SELECT 'valid', 'row_pairing', TRUE, {_N} || '/' || {_N} UNION ALL SELECT 'test_no_label', 'row_pairing', {_N} = 0, '0/' || {_N}")(_schema_check)

# -------------------------------------------------------------- sorts, limits
_reg("head_sample", f"SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice FROM lineitem "
     f"ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice LIMIT 1000")(
    lambda spark, sf: read_table(spark, sf, "lineitem")
    .orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").limit(1000)
    .select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"))
_reg("manual_positive_sorted", W() + f"SELECT {KEYCOLS}, customer_id, total FROM txn WHERE product_id = 'M' AND total > 0 "
     f"ORDER BY total, {KEYCOLS}")(
    lambda spark, sf: _log(spark, sf).filter((F.col("product_id") == "M") & (F.col("total") > 0))
    .select(*LOG_ORDER[1:], "customer_id", "total").orderBy("total", *LOG_ORDER[1:]))

# ------------------------------------------------------- scalar, set ops
_reg("month_shift", W() + "SELECT ym, strftime(strptime(ym, '%Y-%m') - INTERVAL 1 MONTH, '%Y-%m') AS prev_month, "
     "strftime(strptime(ym, '%Y-%m') - INTERVAL 12 MONTH, '%Y-%m') AS prev_year, "
     "strftime(strptime(ym, '%Y-%m') + INTERVAL 1 MONTH, '%Y-%m') AS next_month "
     "FROM (SELECT DISTINCT strftime(order_date, '%Y-%m') AS ym FROM txn) m")(
    lambda spark, sf: _log(spark, sf).select(year_month("order_date").alias("ym")).distinct().select(
        "ym", WN_shift(F.col("ym"), -1).alias("prev_month"), WN_shift(F.col("ym"), -12).alias("prev_year"),
        WN_shift(F.col("ym"), 1).alias("next_month")))


# --------------------------------------------------- preprocessing L1-L8
_ANCH3 = [ym_shift(TARGET, -2), TRAIN, TARGET]


def _multi_anchor_sql() -> str:
    aggs = ",\n  ".join(f'{SQ.stat(chr(34) + c + chr(34), s)} AS "{c}-{s}"' for c in ["quantity", "price", "total"]
                        for s in STATS7)
    inner = SQ.with_(SQ.anchors_cte(_ANCH3, "txn", "ra"),
                     f"blk AS (SELECT customer_id, year_month,\n  {aggs}\nFROM ra GROUP BY 1, 2)",
                     SQ.labels_cte(_ANCH3)) + \
        "SELECT lab.customer_id, lab.year_month, lab.label, blk.* EXCLUDE (customer_id, year_month) FROM lab " \
        "LEFT JOIN blk USING (customer_id, year_month)"
    return SQ.wrap_float(inner, [f"{c}-{s}" for c in ["quantity", "price", "total"] for s in STATS7 if s != "count"])


_reg("multi_anchor_train", _multi_anchor_sql())(
    lambda spark, sf: _fl(FE.multi_anchor_features(_log(spark, sf), _ANCH3, FE.BASE_SPEC)))


def _cust_cat(spark, sf):
    cu = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    na = read_table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return cu.join(na, "c_nationkey").select("c_custkey", "n_name", "c_mktsegment")


_CC = ("cc AS (SELECT c.c_custkey, n.n_name, c.c_mktsegment FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)",)


def _enc_sql(src: str, cols: list[str], fit: str | None = None) -> str:
    fit = fit or src
    sel = ", ".join(f"(SELECT code FROM (SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS code FROM "
                    f"(SELECT DISTINCT {c} AS v FROM {fit} WHERE {c} IS NOT NULL) d) e WHERE e.v = s.{c}) AS {c}"
                    for c in cols)
    return sel


_reg("label_encode", "WITH " + _CC[0] + " SELECT s.c_custkey, " + _enc_sql("cc", ["n_name", "c_mktsegment"]) + " FROM cc s")(
    lambda spark, sf: PR.label_encode(_cust_cat(spark, sf), ["n_name", "c_mktsegment"]))


def _enc_cat(spark, sf):
    df = _cust_cat(spark, sf).withColumn("split", F.when(F.col("c_custkey") % 2 == 0, "train").otherwise("test"))
    tr, te = PR.encode_categoricals(df.filter(F.col("split") == "train"), df.filter(F.col("split") == "test"),
                                    ["n_name", "c_mktsegment"])
    return tr.unionByName(te)


_reg("encode_categoricals", "WITH " + _CC[0] + ", cs AS (SELECT c_custkey, coalesce(n_name, 'VV_likely') AS n_name, "
     "coalesce(c_mktsegment, 'VV_likely') AS c_mktsegment, CASE WHEN c_custkey % 2 = 0 THEN 'train' ELSE 'test' END AS split FROM cc) "
     "SELECT s.c_custkey, " + _enc_sql("cs", ["n_name", "c_mktsegment"]) + ", s.split FROM cs s")(_enc_cat)

_reg("unique_labels", "SELECT v AS label, dense_rank() OVER (ORDER BY v) - 1 AS \"index\" FROM (SELECT DISTINCT v FROM ("
     "SELECT CAST(quality AS VARCHAR) AS v FROM labels UNION ALL SELECT CAST(toxic AS VARCHAR) FROM labels UNION ALL "
     "SELECT CAST(label AS VARCHAR) FROM embeddings) a WHERE v IS NOT NULL) d")(
    lambda spark, sf: SP.unique_labels((read_table(spark, sf, "labels"), "quality"), (read_table(spark, sf, "labels"), "toxic"),
                                       (read_table(spark, sf, "embeddings"), "label")))

_IMP_COLS = [f"{c}-{s}" for c in ["quantity", "price", "total"] for s in ["std", "skew"]]
_STATS_SQL = (f"cs AS (SELECT customer_id, {_sel(sql_stats(['quantity', 'price', 'total'], ['std', 'skew']))} FROM txn "
              f"WHERE order_date < {_ts(TARGET)} GROUP BY 1)")


def _cust_nulls(spark, sf):
    # written once for the null counts, the medians or means and the fill
    return kept(_log(spark, sf).filter(before(TARGET)).groupBy("customer_id")
                .agg(*agg_columns([(c, ["std", "skew"]) for c in ["quantity", "price", "total"]])), "customer-stats")


_reg("median_impute", _fsql(W(_STATS_SQL) + "SELECT customer_id, " + ", ".join(
    f'coalesce("{c}", (SELECT median("{c}") FROM cs)) AS "{c}"' for c in _IMP_COLS) + " FROM cs", _IMP_COLS))(
    lambda spark, sf: _fl(PR.median_impute(_cust_nulls(spark, sf), None, _IMP_COLS)[0]))
_reg("mean_fill", _fsql(W(_STATS_SQL) + "SELECT customer_id, " + ", ".join(
    f'coalesce("{c}", (SELECT avg("{c}") FROM cs)) AS "{c}"' for c in _IMP_COLS) + " FROM cs", _IMP_COLS))(
    lambda spark, sf: _fl(PR.mean_fill(_cust_nulls(spark, sf), None, _IMP_COLS)[0]))

SQ_EPS = 2.220446049250313e-16
_QT_COLS = [f"{c}-{s}" for c in ["quantity", "price", "total"] for s in STATS7]


def _qt(spark, sf, output="uniform"):
    fs = FE.fe_baseline(_log(spark, sf), TARGET)
    tr, te = PR.quantile_transform(fs.train, fs.test, _QT_COLS, 1000, output=output)
    return tr.unionByName(te).select("customer_id", "year_month", *[F.col(f"`{c}`") for c in _QT_COLS])


def _normal_sql(u: str) -> str:
    """The inverse normal of ``u`` in (0, 1) by the library's rational functions, in SQL."""

    def ratio(form, x):
        up, down = (f"{c[-1]!r}::DOUBLE" for c in form)
        for a, b in zip(form[0][-2::-1], form[1][-2::-1]):
            up, down = f"({a!r}::DOUBLE + ({x}) * {up})", f"({b!r}::DOUBLE + ({x}) * {down})"
        return f"({up} / {down})"

    return (f"CASE WHEN abs({u} - 0.5) <= 0.425 THEN ({u} - 0.5) * {ratio(PR._MIDDLE, f'0.180625::DOUBLE - ({u} - 0.5) * ({u} - 0.5)')} "
            f"ELSE sign({u} - 0.5) * CASE WHEN sqrt(-ln(least({u}, 1 - {u}))) <= 5 THEN {ratio(PR._TAIL, f'sqrt(-ln(least({u}, 1 - {u}))) - 1.6::DOUBLE')} "
            f"ELSE {ratio(PR._FAR, f'sqrt(-ln(least({u}, 1 - {u}))) - 5')} END END")


def _qt_sql(normal: bool = False) -> str:
    base = SQ.simple_sql(TARGET, _BASE_SPEC, normalize=False)
    low, high = (float(v) for v in PR.normal_quantiles([PR.BOUNDS_THRESHOLD - SQ_EPS, 1 - (PR.BOUNDS_THRESHOLD - SQ_EPS)]))
    end = f"CASE WHEN u <= 0 THEN {low!r}::DOUBLE WHEN u >= 1 THEN {high!r}::DOUBLE ELSE greatest({low!r}::DOUBLE, least({high!r}::DOUBLE, {_normal_sql('u')})) END" if normal else "u"
    tl = " UNION ALL ".join(f"SELECT '{c}' AS col, CAST(\"{c}\" AS DOUBLE) AS v FROM b WHERE year_month = '{TRAIN}'" for c in _QT_COLS)
    xl = " UNION ALL ".join(f"SELECT customer_id, year_month, '{c}' AS col, CAST(\"{c}\" AS DOUBLE) AS x FROM b" for c in _QT_COLS)
    q = f"""WITH b AS ({base}),
tl AS (SELECT * FROM ({tl}) t WHERE v IS NOT NULL),
rk AS (SELECT col, v, row_number() OVER (PARTITION BY col ORDER BY v) - 1 AS r, count(*) OVER (PARTITION BY col) AS n FROM tl),
qq AS (SELECT DISTINCT col, n, least(1000, n) AS Q FROM rk),
hq AS (SELECT qq.col, s.j, qq.Q, CASE WHEN qq.Q = 1 THEN 0 ELSE ((qq.n - 1) * s.j) // (qq.Q - 1) END AS lo,
       CASE WHEN qq.Q = 1 THEN 0.0 ELSE CAST(((qq.n - 1) * s.j) % (qq.Q - 1) AS DOUBLE) / (qq.Q - 1) END AS fr,
       CASE WHEN qq.Q = 1 THEN 0.0 ELSE CAST(s.j AS DOUBLE) / (qq.Q - 1) END AS ref
       FROM qq, range(0, 1000) s(j) WHERE s.j < qq.Q),
qv AS (SELECT hq.col, hq.j, hq.ref, CASE WHEN hq.fr = 0 THEN a.v ELSE a.v + hq.fr * (c.v - a.v) END AS q0
       FROM hq JOIN rk a ON a.col = hq.col AND a.r = hq.lo LEFT JOIN rk c ON c.col = hq.col AND c.r = hq.lo + 1),
qm AS (SELECT col, j, ref, max(q0) OVER (PARTITION BY col ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS q,
       count(*) OVER (PARTITION BY col) AS Q FROM qv),
xs AS ({xl}),
ab AS (SELECT xs.customer_id, xs.year_month, xs.col, xs.x, max(qm.j) FILTER (WHERE qm.q <= xs.x) AS a, min(qm.j) FILTER (WHERE qm.q >= xs.x) AS b,
       min(qm.q) AS qmin, max(qm.q) AS qmax, max(qm.Q) AS Q FROM xs JOIN qm USING (col) GROUP BY 1, 2, 3, 4),
iv AS (SELECT ab.*,
  CASE WHEN ab.x <= ab.qmin THEN 0.0 WHEN ab.x >= ab.qmax THEN 1.0
       ELSE qa.ref + (ab.x - qa.q) * (qa1.ref - qa.ref) / (qa1.q - qa.q) END AS ir,
  CASE WHEN ab.x <= ab.qmin THEN 0.0 WHEN ab.x > ab.qmax THEN 1.0
       ELSE qb.ref - (qb.q - ab.x) * (qb.ref - qb1.ref) / (qb.q - qb1.q) END AS il
  FROM ab LEFT JOIN qm qa ON qa.col = ab.col AND qa.j = ab.a LEFT JOIN qm qa1 ON qa1.col = ab.col AND qa1.j = ab.a + 1
          LEFT JOIN qm qb ON qb.col = ab.col AND qb.j = ab.b LEFT JOIN qm qb1 ON qb1.col = ab.col AND qb1.j = ab.b - 1),
fin0 AS (SELECT customer_id, year_month, col, CASE WHEN {"x - 1e-7 < qmin" if normal else "x = qmin"} THEN 0.0::DOUBLE WHEN {"x + 1e-7 > qmax" if normal else "x = qmax"} THEN 1.0::DOUBLE ELSE 0.5 * (ir + il) END AS u FROM iv),
fin AS (SELECT customer_id, year_month, col, {end} AS u FROM fin0)
SELECT customer_id, year_month, {", ".join(f"max(u) FILTER (WHERE col = '{c}') AS \"{c}\"" for c in _QT_COLS)} FROM fin GROUP BY customer_id, year_month"""
    return q


_reg("quantile_uniform", _fsql(_qt_sql(), _QT_COLS))(lambda spark, sf: _fl(_qt(spark, sf)))
_reg("quantile_normal", _fsql(_qt_sql(normal=True), _QT_COLS))(lambda spark, sf: _fl(_qt(spark, sf, "normal")))


def _u_sql(key: str, seed: int) -> str:
    """The library's repeatable draw from a key, in SQL."""
    return f"(CAST('0x' || substr(md5({key} || ':{seed}'), 1, 7) AS BIGINT) / 268435456.0::DOUBLE)"


_MASK = {c: _u_sql(f"customer_id || '/{c}'", 0) + " < 0.2" for c in _QT_COLS}
_reg("mask_features", _fsql("SELECT customer_id, year_month, label, " + ", ".join(
    f'CASE WHEN {m} THEN 0.0 ELSE CAST("{c}" AS DOUBLE) END AS "{c}", CAST({m} AS INTEGER) AS "{c}__mask"' for c, m in _MASK.items()) +
    f" FROM ({SQ.simple_sql(TARGET, _BASE_SPEC, normalize=False)}) b", _QT_COLS))(
    lambda spark, sf: _fl(PR.mask_features(FE.fe_baseline(_log(spark, sf), TARGET).frame, "customer_id", _QT_COLS, 0.2, seed=0)))

# ------------------------------------------------------------- splits M1-M5


def _lab(spark, sf):
    # a row a customer, written once: class counts, folds, draws and bounds read it instead of the log
    return kept(LB.label_month(_log(spark, sf), TARGET).select("customer_id", "label"), "labels")


_LAB1 = _BIN[:1]
_reg("random_split", W(*_LAB1) + f"SELECT customer_id, label, CASE WHEN {_u_sql('customer_id', 0)} < 0.8 THEN 'train' "
     f"WHEN {_u_sql('customer_id', 0)} < 0.8 + 0.1 THEN 'valid' ELSE 'test' END AS \"Set\" FROM lab1")(lambda spark, sf: SP.random_split(_lab(spark, sf), "customer_id", seed=0))
_reg("two_step_split", W(*_LAB1) + f"SELECT customer_id, label, CASE WHEN {_u_sql('customer_id', 0)} < 0.2 THEN 'test' "
     f"WHEN {_u_sql('customer_id', 1)} < 0.2 / 0.6 THEN 'valid' ELSE 'train' END AS \"Set\" FROM lab1")(lambda spark, sf: SP.two_step_split(_lab(spark, sf), "customer_id", seed=0))
_reg("stratified_folds", W(*_LAB1) + "SELECT customer_id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY customer_id) - 1) "
     "% 10 AS INTEGER) AS fold FROM lab1")(
    lambda spark, sf: SP.stratified_folds(_lab(spark, sf), "label", "customer_id", 10))
_reg("class_weights", _fsql(W(*_LAB1) + "SELECT customer_id, label, 1.0 / count(*) OVER (PARTITION BY label) AS weight FROM lab1",
                            ["weight"]))(
    lambda spark, sf: _fl(SP.class_weights(_lab(spark, sf), "label", 1)))
_RESAMPLE = W(*_LAB1, "cw AS (SELECT customer_id, label, 1.0 / count(*) OVER (PARTITION BY label) AS weight FROM lab1)",
              "pl AS (SELECT *, sum(weight) OVER (ORDER BY customer_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM cw)",
              "dr AS (SELECT i, CAST('0x' || substr(md5(i || ':0'), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE * (SELECT max(upto) FROM pl) AS place "
              "FROM (SELECT unnest(range(0, (SELECT count(*) FROM cw))) AS i) r)",
              "hit AS (SELECT pl.customer_id, pl.label, pl.weight, dr.i FROM dr ASOF JOIN (SELECT *, upto - weight AS low FROM pl) pl ON dr.place >= pl.low)")
_reg("weighted_resample", _fsql(_RESAMPLE + "SELECT customer_id, label, weight, row_number() OVER (PARTITION BY customer_id ORDER BY i) AS _copy FROM hit", ["weight"]))(
    lambda spark, sf: _fl(SP.weighted_resample(SP.class_weights(_lab(spark, sf), "label", 1), "weight", "customer_id", seed=0), ["weight"]))

# ------------------------------------------------------------- SMOTE L7
from cartcast.operators import smote as SM  # noqa: E402

#: Fixed scales of the baseline features: distances shouldn't be those of the largest column alone.
_SM_SCALE = {"quantity": 50.0, "price": 2000.0, "total": 50000.0}
_SM_COLS = [f"{c}-{s}" for c in _SM_SCALE for s in STATS7]


def _scaled_base(spark, sf) -> DataFrame:
    fs = FE.fe_baseline(_log(spark, sf), TARGET)
    return kept(fs.train.select("customer_id", "label", *[(F.col(f"`{c}`") / _SM_SCALE[c.split("-")[0]]).alias(c) for c in _SM_COLS]), "smote-input")


def _smote_sql() -> str:
    scaled = ", ".join(f'CAST("{c}" AS DOUBLE) / {_SM_SCALE[c.split("-")[0]]} AS x{i}' for i, c in enumerate(_SM_COLS))
    far = " + ".join(f"(a.x{i} - b.x{i}) * (a.x{i} - b.x{i})" for i in range(len(_SM_COLS)))
    return f"""WITH base AS ({SQ.simple_sql(TARGET, _BASE_SPEC, normalize=False)}),
tr AS (SELECT customer_id, label, {scaled} FROM base WHERE year_month = '{TRAIN}'),
few AS (SELECT * FROM tr WHERE label = 1),
pairs AS (SELECT a.customer_id, b.customer_id AS neighbour, sqrt({far}) AS distance FROM few a JOIN few b ON a.customer_id <> b.customer_id),
near AS (SELECT *, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY distance, neighbour) AS INTEGER) AS rank FROM pairs QUALIFY rank <= 5)"""


_SMOTE_ROWS = (_smote_sql() + """,
base_at AS (SELECT customer_id AS base, list(neighbour ORDER BY rank) AS near, row_number() OVER (ORDER BY customer_id) - 1 AS spot FROM near GROUP BY customer_id),
draws AS (SELECT i, floor(""" + _u_sql("i", 0) + """ * (SELECT count(*) FROM base_at)) AS spot, """ + _u_sql("i", 1) + " AS pick, " + _u_sql("i", 2) + """ AS gap
  FROM (SELECT unnest(range(0, (SELECT count(*) FILTER (label <> 1) - count(*) FILTER (label = 1) FROM tr))) AS i) r),
picked AS (SELECT i, base, gap, near[1 + CAST(floor(pick * len(near)) AS INTEGER)] AS neighbour FROM draws JOIN base_at USING (spot))
SELECT i AS synthetic, base, neighbour, gap, """ + ", ".join(f'a.x{i} + gap * (b.x{i} - a.x{i}) AS "{c}"' for i, c in enumerate(_SM_COLS)) +
               ", 1 AS label FROM picked JOIN few a ON a.customer_id = base JOIN few b ON b.customer_id = neighbour")
_reg("smote_neighbours", _fsql(_smote_sql() + " SELECT customer_id, rank, neighbour, distance FROM near", ["distance"]))(
    lambda spark, sf: _fl(SM.nearest(_scaled_base(spark, sf).where("label = 1"), "customer_id", _SM_COLS)))
_reg("smote_rows", _fsql(_SMOTE_ROWS, ["gap", *_SM_COLS]))(
    lambda spark, sf: _fl(SM.smote(_scaled_base(spark, sf), _SM_COLS)))

# ----------------------------------------------- importance reports (fixed)


def _importance(spark, sf) -> DataFrame:
    """Fixed importance table from the data: |corr(feature, label)| on the
    rows of each of 5 stratified folds of the baseline train frame."""
    fs = FE.fe_baseline(_log(spark, sf), TARGET)
    tr = SP.stratified_folds(fs.train, "label", "customer_id", 5)
    long = tr.select((F.col("fold") + 1).alias("fold"), F.col("label").cast("double").alias("label"), F.explode(F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("value")) for c in fs.features])).alias("_p"))
    c = F.corr("_p.value", "label")
    return long.groupBy(F.col("_p.feature").alias("feature"), "fold").agg(
        F.when(c.isNull() | F.isnan(c), F.lit(0.0)).otherwise(F.round(F.abs(c), 10)).alias("importance"))


def _imp_sql() -> str:
    base = SQ.simple_sql(TARGET, _BASE_SPEC, normalize=False)
    feats = [f"{c}-{s}" for c in ["quantity", "price", "total"] for s in STATS7]
    un = " UNION ALL ".join(f"SELECT '{c}' AS feature, fold, label, CAST(\"{c}\" AS DOUBLE) AS value FROM tf" for c in feats)
    return (f"WITH b AS ({base}), tf AS (SELECT *, CAST((row_number() OVER (PARTITION BY label ORDER BY customer_id) - 1) % 5 + 1 "
            f"AS INTEGER) AS fold, CAST(label AS DOUBLE) AS yl FROM b WHERE year_month = '{TRAIN}'), "
            f"lg AS ({un.replace('fold, label,', 'fold, yl AS label,')}), "
            "fi AS (SELECT feature, fold, CASE WHEN corr(value, label) IS NULL OR isnan(corr(value, label)) THEN 0.0 "
            "ELSE round(abs(corr(value, label)), 10) END AS importance FROM lg GROUP BY 1, 2)")


_reg("importance_mean", _fsql(_imp_sql() + " SELECT feature, avg(importance) AS importance FROM fi GROUP BY 1", ["importance"]))(
    lambda spark, sf: _fl(RP.importance_mean(_importance(spark, sf))))
_RANK_SQL = (", m AS (SELECT feature, avg(importance) AS importance FROM fi GROUP BY 1), "
             "r AS (SELECT feature, importance, importance / sum(importance) OVER () AS importance_normalized, "
             "row_number() OVER (ORDER BY importance DESC, feature) AS rank FROM m), "
             "c AS (SELECT *, sum(importance_normalized) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
             "AS cumulative_importance FROM r)")
_reg("importance_cumulative", _fsql(_imp_sql() + _RANK_SQL + " SELECT feature, importance, importance_normalized, "
                                    "CAST(rank AS INTEGER) AS rank, cumulative_importance FROM c",
                                    ["importance", "importance_normalized", "cumulative_importance"]))(
    lambda spark, sf: _fl(RP.importance_ranked(RP.importance_mean(_importance(spark, sf)))))
_reg("importance_top20", _fsql(_imp_sql() + _RANK_SQL + " SELECT feature, importance, importance_normalized, "
                               "CAST(rank AS INTEGER) AS rank, cumulative_importance FROM c WHERE rank <= 20",
                               ["importance", "importance_normalized", "cumulative_importance"]))(
    lambda spark, sf: _fl(RP.importance_top(RP.importance_mean(_importance(spark, sf)), 20)))


def _rollup(spark, sf):
    fi = _importance(spark, sf)
    mapping = fi.select("feature").distinct().select("feature", F.split("feature", "-")[0].alias("source"))
    return _fl(RP.importance_rollup(fi, mapping))


_reg("importance_rollup", _fsql(_imp_sql() + " SELECT split_part(feature, '-', 1) AS source, sum(importance) / "
                                "(SELECT sum(importance) FROM fi) AS importance FROM fi GROUP BY 1", ["importance"]))(_rollup)


def _fold_columns(spark, sf):
    # The fold columns of a wide importance table, picked by their name
    wide = RP.importance_wide(_importance(spark, sf), range(1, 6))
    return _fl(wide.select("feature", RP.mean_across(SP.columns_like(wide, "^fold_")).alias("importance")))


_reg("fold_columns_mean", _fsql(_imp_sql() + " SELECT feature, avg(importance) AS importance FROM fi GROUP BY 1", ["importance"]))(_fold_columns)


def _fold_auc(spark, sf):
    s = SP.stratified_folds(_bin_scores(spark, sf), "label", "customer_id", 5)
    return _fl(MT.roc_auc(s, "label", "score", by="fold"))


_reg("fold_auc", _fsql(W(*_BIN, "fb AS (SELECT *, CAST((row_number() OVER (PARTITION BY label ORDER BY customer_id) - 1) % 5 "
                       "AS INTEGER) AS fold FROM bs)") + _auc_sql("fb", "score", by="fold"), ["auc"]))(_fold_auc)


# ------------------------------------------------------ models N1-N14, A7
from cartcast.operators import boost as BO  # noqa: E402
from cartcast.operators import model as MD  # noqa: E402

_GBT_Q = MD.BoostParams(patience=20)  # of 10,000 trees: the patience ends it (the reference's is 100)


def _full_scaled(spark, sf, ym=TARGET):
    """The full builder with every feature mapped through its train quantiles, each side written once."""
    fs = FE.fe_full(_log(spark, sf), ym)
    # written once for the quantiles and both sides
    frame = kept(fs.frame, "features")
    tr, te = (frame.where(F.col("year_month") == m) for m in (fs.train_month, fs.test_month))
    tr, te = PR.quantile_transform(tr, te, fs.features, 1000)
    return fs, kept(tr, "train-scaled"), kept(te, "test-scaled")


def _fit_args(fs) -> dict:
    # scaled features are spread evenly: their bins need no quantiles
    return {"params": _GBT_Q, "edges": BO.unit_edges(fs.features, _GBT_Q.bins)}


def _oof_run(spark, sf, ym=TARGET):
    fs, tr, te = _full_scaled(spark, sf, ym)
    return te, MD.oof_predictions(tr, te, fs.features, folds=10, **_fit_args(fs))


def _oof(spark, sf):
    return _oof_run(spark, sf)[1].oof


def _gbt(spark, sf):
    fs, tr, te = _full_scaled(spark, sf)
    return MD.gbt_scores(tr, te, fs.features, **_fit_args(fs))


def _emb_cols(spark, sf):
    e = read_table(spark, sf, "embeddings")
    d = e.agg(F.max(F.size("embedding"))).first()[0]  # the whole vector
    cols = [F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(d)]
    return e.select("vec_id", "label", *cols), [f"e{i}" for i in range(d)]


def _multiclass(spark, sf):
    df, feats = _emb_cols(spark, sf)
    df = SP.random_split(df, "vec_id", probs=(0.8, 0.2), names=("train", "test"), seed=1)
    m = MD.fit_multiclass(df.filter(F.col("Set") == "train"), feats, "label", num_trees=30)
    return MD.predict_class(m, df.filter(F.col("Set") == "test"), "vec_id")


def _predict_class(spark, sf):
    df, feats = _emb_cols(spark, sf)
    df = SP.random_split(df, "vec_id", probs=(0.8, 0.2), names=("train", "test"), seed=1)
    m = MD.fit_multiclass(df.filter(F.col("Set") == "train"), feats, "label", num_trees=30)
    names = read_table(spark, sf, "nation").select(F.col("n_nationkey").alias("class"), F.col("n_name").alias("pred_name"))
    out = MD.predict_class(m, df.filter(F.col("Set") == "test"), "vec_id", names)
    return out.withColumn("argmax", MT.argmax(F.col("proba")))


def _regression(spark, sf):
    # two targets of the next month, spend and number of log rows, on all features
    fs, tr, te = _full_scaled(spark, sf)
    log = _log(spark, sf)
    nxt = log.groupBy("customer_id", year_month("order_date").alias("year_month")).agg(F.sum("total").alias("next_spend"), F.count("*").cast("double").alias("next_rows"))
    tr = tr.join(nxt, ["customer_id", "year_month"], "left").fillna(0.0, subset=["next_spend", "next_rows"])
    return MD.regression_scores(tr, te, fs.features, ["next_spend", "next_rows"], "customer_id", **_fit_args(fs))


def _doc_features(spark, sf):
    d = read_table(spark, sf, "documents")
    lab = read_table(spark, sf, "labels")
    t = F.col("text")
    n = F.greatest(F.length(t), F.lit(1)).cast("double")
    feats = d.select("doc_id", F.col("n_chars").cast("double").alias("n_chars"),
                     F.size(F.split(t, "\\\\s+")).cast("double").alias("words"),
                     (F.length(F.regexp_replace(t, "[^0-9]", "")) / n).alias("digit_share"),
                     (F.length(F.regexp_replace(t, "[^A-Z]", "")) / n).alias("upper_share"),
                     F.size(F.split(t, "\\n")).cast("double").alias("lines"))
    # written once: edges, both models and the scores read numbers, not texts
    return kept(feats.join(lab, "doc_id"), "text-features"), ["n_chars", "words", "digit_share", "upper_share", "lines"]


def _multitask(spark, sf):
    df, feats = _doc_features(spark, sf)
    df = SP.random_split(df, "doc_id", probs=(0.8, 0.2), names=("train", "test"), seed=2)
    return MD.multitask_scores(df.filter(F.col("Set") == "train"), df.filter(F.col("Set") == "test"), feats,
                               ["quality", "toxic"], "doc_id", _GBT_Q)


def _model_selection(spark, sf):
    fs, tr, te = _full_scaled(spark, sf)
    return MD.model_selection(tr, fs.features, folds=5, **_fit_args(fs))


def _learning_curve(spark, sf):
    fs, tr, te = _full_scaled(spark, sf)
    return MD.learning_curve(tr, fs.features, **_fit_args(fs))


def _pipeline_submission(spark, sf):
    # full features -> quantiles of all -> 10-fold out-of-fold models -> submission
    te, r = _oof_run(spark, sf)
    return IO.submission(te, r.test)


def _model_importance(spark, sf):
    return RP.importance_ranked(RP.importance_mean(_oof_run(spark, sf)[1].importance))


def _backtest(spark, sf):
    # Build at the previous month, score it and compare with its known labels
    te, r = _oof_run(spark, sf, TRAIN)
    scored = te.select("customer_id", "label").join(r.test, "customer_id")
    auc = MT.roc_auc(scored, "label", "probability")
    thr = MT.threshold_metrics(scored, "label", "probability")
    return _one_row(auc, thr, r.oof_auc.withColumnRenamed("auc", "oof_auc"))


def _roundtrip(spark, sf):
    fs, tr, te = _full_scaled(spark, sf)
    return MD.save_load_roundtrip(tr, te, fs.features, IO.scratch_path(spark, "model"), **_fit_args(fs))


_reg("oof_predictions")(_oof)
_reg("gbt_scores")(_gbt)
_reg("multiclass_scores")(_multiclass)
_reg("predict_class")(_predict_class)
_reg("regression_scores")(_regression)
_reg("multitask_scores")(_multitask)
_reg("model_selection")(_model_selection)
_reg("gbt_learning_curve")(_learning_curve)
_reg("backtest_month")(_backtest)
_reg("pipeline_submission")(_pipeline_submission)
_reg("model_importance")(_model_importance)
_reg("model_roundtrip_scores", W(*_LAB1) + "SELECT count(*) AS rows, 0.0::DOUBLE AS max_abs_diff, 0::BIGINT AS differing FROM lab1")(_roundtrip)


def _optional(name: str):
    """A module of the training-data part, or None if that part isn't there."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as e:
        if (e.name or "").split(".")[0] == "corpus_pipeline" or (e.name or "").startswith("cartcast.llm"):
            return None
        raise


_LLM = _optional("cartcast.llm.queries")
_PIPELINE = _optional("corpus_pipeline")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _Q | (_LLM.QUERIES if _LLM else {}) | ({"pipeline": _PIPELINE.run} if _PIPELINE else {})


def oracle_sql() -> dict[str, str]:
    return _S | (_LLM.SQL if _LLM else {}) | (
        {"pipeline": _PIPELINE.ORACLE_SQL} if _PIPELINE and _PIPELINE.ORACLE_SQL else {})


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the full 380-feature train/test frame (K4) at sf0.001."""
    return FE.fe_full(_log(spark, SF_SMOKE), TARGET).frame
