"""SQL text (DuckDB dialect) for the feature builders.

Written directly from the reference semantics with plain window functions,
FILTER aggregates and joins: a second, independent implementation of what the
Spark builders do with range-partitioned scans, explodes and pivots.
"""

from __future__ import annotations

# Fixed values shared with the builders (reference constants).
STATS7 = ["mean", "max", "min", "sum", "count", "std", "skew"]
STATS7_WINDOW = ["max", "min", "sum", "mean", "count", "std", "skew"]
TREND_BACK = [1, 2, 3, 5, 7, 12, 20, 23]
SEASON_BACK = [1, 6, 12, 18]
ORD = "order_date, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"
KEYCOLS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"

SGN = "(CASE WHEN l.l_returnflag = 'R' THEN -1 ELSE 1 END)"
TXN = f"""txn AS (
  SELECT
    CASE WHEN l.l_returnflag = 'R' THEN 'C' || CAST(l.l_orderkey AS VARCHAR) ELSE CAST(l.l_orderkey AS VARCHAR) END AS order_id,
    CASE WHEN l.l_partkey % 50 = 0 THEN 'M' WHEN l.l_partkey % 7 = 0 THEN CAST(l.l_partkey AS VARCHAR) || 'A'
         ELSE CAST(l.l_partkey AS VARCHAR) END AS product_id,
    p.p_name AS description,
    CAST(l.l_quantity * {SGN} AS DOUBLE) AS quantity,
    o.o_orderdate AS order_date,
    l.l_extendedprice / l.l_quantity AS price,
    o.o_custkey AS customer_id,
    n.n_name AS country,
    CAST(l.l_extendedprice * {SGN} AS DOUBLE) AS total,
    l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""


def ym_index(ym: str) -> int:
    y, m = ym.split("-")
    return int(y) * 12 + int(m) - 1


def ym_shift(ym: str, k: int) -> str:
    i = ym_index(ym) + k
    return f"{i // 12:04d}-{i % 12 + 1:02d}"


def ts(ym: str) -> str:
    return f"TIMESTAMP '{ym}-01 00:00:00'"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join((TXN,) + ctes) + "\n"


def q(name: str) -> str:
    return '"' + name + '"'


def stat(x: str, s: str, filt: str | None = None) -> str:
    f = f" FILTER (WHERE {filt})" if filt else ""
    base = {
        "mean": f"avg({x}){f}", "max": f"max({x}){f}", "min": f"min({x}){f}",
        "sum": f"coalesce(sum({x}){f}, 0.0)", "count": f"count({x}){f}",
        "std": f"stddev_samp({x}){f}",
        "skew": (f"CASE WHEN count({x}){f} < 3 THEN NULL WHEN max({x}){f} = min({x}){f} THEN 0.0 "
                 f"ELSE skewness({x}){f} END"),
    }[s]
    return base


def double_stats(names_stats) -> list[str]:
    return [n for n, s in names_stats if s != "count"]


# --------------------------------------------------------------- row features

def rowfeat_ctes(cut_ym: str) -> list[str]:
    """CTE ``rf``: rows before ``cut_ym`` with every row-level column of K4."""
    wc = f"OVER (PARTITION BY customer_id ORDER BY {ORD})"

    def cum(key):
        return f"OVER (PARTITION BY {key} ORDER BY {ORD} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    cums = []
    for key, tag in [("customer_id", "cust_id"), ("product_id", "prod_id"), ("order_id", "order_id")]:
        for v in ["total", "quantity", "price"]:
            cums.append(f'sum({v}) {cum(key)} AS "cumsum_{v}_by_{tag}"')
    return [
        f"cut AS (SELECT *, epoch(order_date) AS order_ts FROM txn WHERE order_date < {ts(cut_ym)})",
        f"pg AS (SELECT {KEYCOLS}, order_ts - lag(order_ts) {wc} AS g FROM cut WHERE total > 0)",
        "rf AS (SELECT c.*, " + ", ".join(cums) + ", "
        f"c.order_ts - lag(c.order_ts) {wc} AS order_ts_diff, "
        f"c.quantity - lag(c.quantity) {wc} AS quantity_diff, "
        f"c.price - lag(c.price) {wc} AS price_diff, "
        f"c.total - lag(c.total) {wc} AS total_diff, "
        "CASE WHEN c.total > 0 THEN c.order_ts ELSE 0.0 END AS order_ts_plus, "
        "coalesce(pg.g, 0.0) AS order_ts_plus_diff, "
        'CAST(month(c.order_date) AS INTEGER) AS "month-mode", '
        "strftime(c.order_date, '%Y-%m') AS \"year_month-mode\" "
        f"FROM cut c LEFT JOIN pg USING ({KEYCOLS}))",
    ]


def anchors_cte(anchors: list[str], src: str, name: str) -> str:
    arr = ", ".join(f"'{a}'" for a in anchors)
    return (f"{name} AS (SELECT r.*, a.year_month FROM {src} r JOIN (SELECT unnest([{arr}]) AS year_month) a "
            f"ON strftime(r.order_date, '%Y-%m') < a.year_month)")


def labels_cte(anchors: list[str], thr: float = 300.0) -> str:
    parts = []
    for a in anchors:
        parts.append(
            f"SELECT c.customer_id, '{a}' AS year_month, CAST(coalesce(g.t, 0.0) > {thr} AS INTEGER) AS label "
            f"FROM (SELECT DISTINCT customer_id FROM txn WHERE strftime(order_date, '%Y-%m') < '{a}') c "
            f"LEFT JOIN (SELECT customer_id, sum(total) AS t FROM txn WHERE strftime(order_date, '%Y-%m') = '{a}' "
            f"GROUP BY customer_id) g USING (customer_id)")
    return "lab AS (" + " UNION ALL ".join(parts) + ")"


CUMSUM_COLS = [f"cumsum_{v}_by_{k}" for k in ["cust_id", "prod_id", "order_id"] for v in ["total", "quantity", "price"]]
FULL_STAT_COLS = (["order_ts_diff", "order_ts_plus_diff", "quantity_diff", "price_diff", "total_diff",
                   "quantity", "price", "total"] + CUMSUM_COLS)


def full_row_aggs() -> list[tuple[str, str, str]]:
    """(name, expr, kind) in builder order; kind 'd' double, 'l' bigint, 'i' int, 's' string."""
    out = []

    def fl(c):
        out.append((f"{c}-first", f"arg_min({q(c)}, ({ORD}))", "d"))
        out.append((f"{c}-last", f"arg_max({q(c)}, ({ORD}))", "d"))

    def st(c):
        for s in STATS7:
            out.append((f"{c}-{s}", stat(q(c), s), "l" if s == "count" else "d"))
    fl("order_ts")
    st("order_ts_diff")
    fl("order_ts_plus")
    for c in ["order_ts_plus_diff", "quantity_diff", "price_diff", "total_diff", "quantity", "price", "total",
              *CUMSUM_COLS]:
        st(c)
    return out


def mode_cte(col: str, name: str, src: str = "ra") -> str:
    return (f"{name} AS (SELECT customer_id, year_month, v FROM (SELECT customer_id, year_month, v, row_number() OVER "
            f"(PARTITION BY customer_id, year_month ORDER BY n DESC, v ASC) AS rn FROM (SELECT customer_id, year_month, "
            f"{q(col)} AS v, count(*) AS n FROM {src} WHERE {q(col)} IS NOT NULL GROUP BY 1, 2, 3) a) b WHERE rn = 1)")


# ------------------------------------------------------------ window features

def window_defs(trend: bool, season: bool):
    """(label, condition on back) pairs."""
    out = []
    if trend:
        out += [(str(i), f"back <= {k}") for i, k in enumerate(TREND_BACK)]
    if season:
        out += [(f"season{i}", f"back BETWEEN {k} AND {k + 2}") for i, k in enumerate(SEASON_BACK)]
    return out


def window_cols(trend: bool, season: bool) -> list[tuple[str, str, str]]:
    out = []
    for lab, cond in window_defs(trend, season):
        for c in ["quantity", "price", "total"]:
            for s in STATS7_WINDOW:
                e = stat(c, s, cond)
                if s == "count":
                    e = f"CAST({e} AS DOUBLE)"
                out.append((f"{c}-{s}-{lab}", f"CASE WHEN count(*) FILTER (WHERE {cond}) = 0 THEN NULL ELSE {e} END",
                            "d"))
    return out


def window_ctes(anchors: list[str], src: str = "txn", trend=True, season=True) -> list[str]:
    arr = ", ".join(f"'{a}'" for a in anchors)
    defs = window_defs(trend, season)
    anyw = " OR ".join(f"({c})" for _, c in defs)
    cols = ",\n  ".join(f"{e} AS {q(n)}" for n, e, _ in window_cols(trend, season))
    return [
        f"wr AS (SELECT r.customer_id, r.quantity, r.price, r.total, a.year_month, "
        f"(CAST(substr(a.year_month, 1, 4) AS INTEGER) * 12 + CAST(substr(a.year_month, 6, 2) AS INTEGER) - 1)"
        f" - (year(r.order_date) * 12 + month(r.order_date) - 1) AS back "
        f"FROM {src} r JOIN (SELECT unnest([{arr}]) AS year_month) a ON strftime(r.order_date, '%Y-%m') < a.year_month)",
        f"win AS (SELECT customer_id, year_month,\n  {cols}\nFROM wr WHERE {anyw} GROUP BY customer_id, year_month)",
    ]


def cycle_cte(anchors: list[str], src: str = "txn") -> str:
    arr = ", ".join(f"'{a}'" for a in anchors)
    back = ("(CAST(substr(a.year_month, 1, 4) AS INTEGER) * 12 + CAST(substr(a.year_month, 6, 2) AS INTEGER) - 1)"
            " - (year(r.order_date) * 12 + month(r.order_date) - 1)")
    return (f"cyc AS (SELECT customer_id, year_month, (coalesce(sum(total) FILTER (WHERE back = 12), 0.0) + "
            f"coalesce(sum(total) FILTER (WHERE back = 24), 0.0)) / 2 AS cycle_1224 FROM ("
            f"SELECT r.customer_id, r.total, a.year_month, {back} AS back FROM {src} r JOIN "
            f"(SELECT unnest([{arr}]) AS year_month) a ON strftime(r.order_date, '%Y-%m') < a.year_month) x "
            f"WHERE back IN (12, 24) GROUP BY customer_id, year_month)")


def norm(c: str) -> str:
    """Check-only normalisation (twin of ``_norm_col`` in the entry file)."""
    k = "CAST('0.7853981633974483' AS DOUBLE)"
    z = f"(CASE WHEN abs({c}) < CAST(1e-9 AS DOUBLE) THEN CAST(0 AS DOUBLE) ELSE CAST({c} AS DOUBLE) END)"
    hundred, cents = "CAST(100 AS DOUBLE)", f"round_even({z} * CAST(100 AS DOUBLE), 0)"
    t = f"({z} * {k})"
    x = f"({t} * CAST({2 ** 27 + 1} AS DOUBLE))"
    return (f"(CASE WHEN abs({z} * {hundred} - {cents}) < CAST(1e-4 AS DOUBLE) THEN {cents} / {hundred} "
            f"ELSE ({x} - ({x} - {t})) / {k} END)")


def wrap_float(inner: str, doubles: list[str]) -> str:
    if not doubles:
        return inner
    rep = ", ".join(f"{norm(q(c))} AS {q(c)}" for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM ({inner}) _q"


# ------------------------------------------------------------------- builders

def trend_sql(anchors, season=False, trend=True, compat=False) -> str:
    ctes = window_ctes(anchors, "txn", trend, season)
    names = window_cols(trend, season)
    where = ""
    if compat:
        where = f" WHERE {q(f'total-count-season{len(SEASON_BACK) - 1}')} IS NOT NULL"
    inner = with_(*ctes) + f"SELECT * FROM win{where}"
    return wrap_float(inner, [n for n, _, k in names if k == "d"])


def cycle_sql(anchors) -> str:
    return wrap_float(with_(cycle_cte(anchors)) + "SELECT * FROM cyc", ["cycle_1224"])


def full_sql(ym: str, compat: bool = False) -> str:
    tr = ym_shift(ym, -1)
    anchors = [tr, ym]
    aggs = full_row_aggs()
    agg_sel = ",\n  ".join(f"{e} AS {q(n)}" for n, e, _ in aggs)
    wcols = window_cols(True, True)
    season_names = [n for n, _, _ in wcols if "-season" in n]
    ctes = rowfeat_ctes(ym) + [
        anchors_cte(anchors, "rf", "ra"),
        f"blk AS (SELECT customer_id, year_month,\n  {agg_sel}\nFROM ra GROUP BY customer_id, year_month)",
        "dst AS (SELECT customer_id, year_month, count(DISTINCT order_id) AS \"order_id-nunique\", "
        "count(DISTINCT product_id) AS \"product_id-nunique\" FROM ra GROUP BY customer_id, year_month)",
        mode_cte("month-mode", "mm"), mode_cte("year_month-mode", "ym"),
        cycle_cte(anchors, "cut"),
        *window_ctes(anchors, "cut"),
        labels_cte(anchors),
    ]
    feats = []
    for n, _, k in aggs:
        feats.append((n, f"coalesce(blk.{q(n)}, 0)", k))
    feats += [("order_id-nunique", 'coalesce(dst."order_id-nunique", 0)', "l"),
              ("product_id-nunique", 'coalesce(dst."product_id-nunique", 0)', "l"),
              ("month-mode-mode", "coalesce(mm.v, 0)", "i"),
              ("year_month-mode-mode", "ym.v", "s"),
              ("cycle_1224", "coalesce(cyc.cycle_1224, 0.0)", "d")]
    for n, _, k in wcols:
        src = f"win.{q(n)}"
        if compat and n in season_names:
            src = f"CASE WHEN win.\"total-count-season3\" IS NOT NULL THEN {src} END"
        feats.append((n, f"coalesce({src}, 0)", k))
    sel = ",\n  ".join(f"{e} AS {q(n)}" for n, e, _ in feats)
    joined = ("j AS (SELECT lab.customer_id, lab.year_month, lab.label,\n  " + sel +
              "\nFROM lab LEFT JOIN blk USING (customer_id, year_month) LEFT JOIN dst USING (customer_id, year_month) "
              "LEFT JOIN mm USING (customer_id, year_month) LEFT JOIN ym USING (customer_id, year_month) "
              "LEFT JOIN cyc USING (customer_id, year_month) LEFT JOIN win USING (customer_id, year_month))")
    enc = ("SELECT j.* REPLACE (CAST(e.code AS BIGINT) AS \"year_month-mode-mode\") FROM j LEFT JOIN "
           "(SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT \"year_month-mode-mode\" AS v "
           "FROM j WHERE \"year_month-mode-mode\" IS NOT NULL) d) e ON j.\"year_month-mode-mode\" = e.v")
    inner = with_(*ctes, joined) + enc
    return wrap_float(inner, [n for n, _, k in feats if k == "d"])


def impute_select(names_kinds, src: str, train_filter: str) -> str:
    """SELECT with each double/bigint feature null-filled by its train median."""
    parts = []
    for n, k in names_kinds:
        if k != "d":
            parts.append(q(n))
            continue
        med = f"(SELECT median({q(n)}) FROM {src} WHERE {train_filter})"
        parts.append(f"CASE WHEN {q(n)} IS NULL THEN {med} ELSE {q(n)} END AS {q(n)}")
    return ", ".join(parts)


def simple_sql(ym: str, spec: list[tuple[str, list[str]]], impute: bool = True, cumsum: bool = False,
               distinct: bool = False, cycle: bool = False, normalize: bool = True) -> str:
    """Builders K2/K3/K5: labels of M-1 and M, aggregates over rows before the
    anchor, median fill from the train rows."""
    tr = ym_shift(ym, -1)
    anchors = [tr, ym]
    aggs = []
    for c, stats in spec:
        for s in stats:
            if s in ("first", "last"):
                f = "arg_min" if s == "first" else "arg_max"
                aggs.append((f"{c}-{s}", f"{f}({q(c)}, ({ORD}))", "d"))
            else:
                aggs.append((f"{c}-{s}", stat(q(c), s), "l" if s == "count" else "d"))
    if distinct:
        aggs += [("order_id-nunique", "count(DISTINCT order_id)", "l"),
                 ("product_id-nunique", "count(DISTINCT product_id)", "l")]
    src = "rf" if (cumsum or any(c.startswith("order_ts") for c, _ in spec)) else "cut0"
    ctes = rowfeat_ctes(ym) if src == "rf" else [f"cut0 AS (SELECT * FROM txn WHERE order_date < {ts(ym)})"]
    ctes += [anchors_cte(anchors, src, "ra"),
             "blk AS (SELECT customer_id, year_month,\n  " + ",\n  ".join(f"{e} AS {q(n)}" for n, e, _ in aggs) +
             "\nFROM ra GROUP BY customer_id, year_month)", labels_cte(anchors)]
    extra = ""
    feats = [(n, k) for n, _, k in aggs]
    if cycle:
        ctes.append(cycle_cte(anchors, "cut"))
        extra = ", coalesce(cyc.cycle_1224, 0.0) AS cycle_1224"
        feats.append(("cycle_1224", "d"))
    joined = ("j AS (SELECT lab.customer_id, lab.year_month, lab.label, " +
              ", ".join(f"blk.{q(n)}" for n, _, _ in aggs) + extra +
              " FROM lab LEFT JOIN blk USING (customer_id, year_month)" +
              (" LEFT JOIN cyc USING (customer_id, year_month)" if cycle else "") + ")")
    if impute:
        body = ("SELECT customer_id, year_month, label, " +
                impute_select(feats, "j", f"year_month = '{tr}'") + " FROM j")
    else:
        body = "SELECT * FROM j"
    if not normalize:
        return with_(*ctes, joined) + body
    return wrap_float(with_(*ctes, joined) + body, [n for n, k in feats if k == "d"])
