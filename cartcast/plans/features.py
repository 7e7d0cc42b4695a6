"""Feature builders (K2-K5, K11, K12): labels + per-customer point-in-time
aggregates for a train anchor (M-1) and a test anchor (M).

The columns that a builder needs are written once; from that table, log rows with their running columns become mergeable
states per customer and stretch between anchors, and both anchors are merges of the states before them, so no
log row is repeated per anchor.  Every block is aggregated on ``(customer_id, year_month)``, so the final
left joins line up on one hash partitioning and shuffle only aggregated rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartcast.functions.months import month_index, month_start, year_month, ym_index, ym_shift
from cartcast.functions.stats import STATS7, agg_columns, mode, spec_names
from cartcast.operators.labels import TOTAL_THRES, label_months
from cartcast.operators.moments import STATS, centred, merged, month_moments, ordered_parts
from cartcast.operators.prep import label_encode, median_impute
from cartcast.operators.rowfeat import cumsum_features, row_features
from cartcast.operators.scan import ScanSpec, ordered_scan
from cartcast.operators.states import with_stats
from cartcast.operators.windows import WINDOW_SPEC, compat_seasons, cycle_1224, window_list
from cartcast.session import kept
from cartcast.sources.tables import LOG_ORDER

KEYS = ["customer_id", "year_month"]
# Row position within the customer's history, set by the customer scan.
ROW_ORDER = ["_rn"]

BASE_SPEC = [(c, STATS7) for c in ["quantity", "price", "total"]]

CUMSUM_COLS = [f"cumsum_{v}_by_{k}" for k in ["cust_id", "prod_id", "order_id"] for v in ["total", "quantity", "price"]]

CUMULATIVE_SPEC = [(c, STATS7) for c in ["quantity", "price", "total", *CUMSUM_COLS]]
DISTINCT_SPEC = [("order_id", ["nunique"]), ("product_id", ["nunique"])]

# The aggregate list of the full builder.
FULL_SPEC = [
    ("order_ts", ["first", "last"]),
    ("order_ts_diff", STATS7),
    ("order_ts_plus", ["first", "last"]),
    ("order_ts_plus_diff", STATS7),
    ("quantity_diff", STATS7),
    ("price_diff", STATS7),
    ("total_diff", STATS7),
    ("quantity", STATS7),
    ("price", STATS7),
    ("total", STATS7),
] + [(c, STATS7) for c in CUMSUM_COLS]
MODE_SPEC = [("month-mode", [mode]), ("year_month-mode", [mode])]

COMPACT_SPEC = [("order_ts", ["first", "last"]), ("order_ts_diff", ["mean", "max"])]

# The pinned feature subset listed by the reference.
PICKED = [
    "order_ts-last", "order_ts-first", "price_diff-skew", "price-skew", "order_ts_diff-max",
    "quantity_diff-skew", "cumsum_total_by_prod_id-skew", "cumsum_price_by_prod_id-skew",
    "cumsum_total_by_cust_id-skew", "cumsum_quantity_by_prod_id-sum", "quantity-skew",
    "cumsum_total_by_order_id-skew", "cumsum_price_by_cust_id-skew", "cumsum_price_by_order_id-skew",
    "year_month-mode", "total_diff-skew", "price-mean", "cumsum_quantity_by_order_id-skew",
    "cumsum_quantity_by_prod_id-skew", "price_diff-mean",
]


@dataclass
class FeatureSet:
    """Train rows (anchor M-1) and test rows (anchor M) in one frame."""

    frame: DataFrame        # customer_id, year_month, label, features...
    features: list[str]
    train_month: str
    test_month: str

    @property
    def train(self) -> DataFrame:
        return self.frame.filter(F.col("year_month") == self.train_month)

    @property
    def test(self) -> DataFrame:
        return self.frame.filter(F.col("year_month") == self.test_month)


def explode_anchors(df: DataFrame, anchors: list[str], cols: list[str] | None = None) -> DataFrame:
    """Each row once per anchor month it lies before (``year_month`` = anchor)."""
    arr = F.array(*[F.lit(a) for a in sorted(anchors)])
    ym = year_month("order_date")
    sel = [F.col(f"`{c}`") for c in (cols or df.columns)]
    return df.select(*sel, F.explode(F.filter(arr, lambda a: a > ym)).alias("year_month"))


def log_order(log: DataFrame, order: list[str] | None) -> list[str]:
    """The columns that order log rows: the caller's, or the raw line keys if the log has them."""
    order = list(order or LOG_ORDER)
    if missing := [c for c in order if c not in log.columns]:
        raise ValueError(f"the log has no column {missing}: give order=[...], columns that put its rows in a unique order")
    return order


def picked_names() -> list[str]:
    """The pinned subset under this builder's names; an unknown name is an error."""
    names = {c: c for c in full_feature_names()} | {"year_month-mode": "year_month-mode-mode"}
    if unknown := [c for c in PICKED if c not in names]:
        raise ValueError(f"unknown feature {unknown}")
    return [names[c] for c in PICKED]


def aggregate_blocks(rows: DataFrame, spec, order=LOG_ORDER, keys=KEYS) -> DataFrame:
    """D3 on already-anchored rows: one aggregate per spec (callers split
    distinct counts and modes into their own block)."""
    return rows.groupBy(*keys).agg(*agg_columns(spec, order))


def _labels(log: DataFrame, anchors: list[str], threshold: float) -> DataFrame:
    return label_months(log, anchors, threshold).select(*KEYS, "label")


def _join_all(labels: DataFrame, blocks: list[DataFrame]) -> DataFrame:
    out = labels
    for b in blocks:
        out = out.join(b, KEYS, "left")
    return out


def _from_months(log: DataFrame, anchors: list[str], spec, threshold: float) -> DataFrame:
    cols = [c for c, _ in spec]
    cut = log.filter(F.col("order_date") < month_start(ym_shift(anchors[-1], 1)))
    months = month_moments(cut, list(dict.fromkeys([*cols, "total"])))
    at = F.array(*[F.struct(F.lit(a).alias("year_month"), F.lit(ym_index(a)).alias("i")) for a in anchors])
    rows = months.withColumn("_a", F.explode(F.filter(at, lambda a: a["i"] >= F.col("_mi"))))
    past = F.col("_a.i") > F.col("_mi")
    parts = [c for c in months.columns if c not in ("customer_id", "_mi")]
    rows = rows.select("customer_id", F.col("_a.year_month").alias("year_month"), past.alias("_past"),
                       F.when(~past, F.col("total_s")).alias("_spend"), *[F.when(past, F.col(c)).alias(c) for c in parts])
    spend = F.coalesce(F.sum("_spend"), F.lit(0.0))
    g = centred(rows, list(dict.fromkeys(cols)), KEYS).groupBy(*KEYS).agg(
        F.max("_past").alias("_seen"), (spend > F.lit(float(threshold))).cast("int").alias("label"),
        *[merged(c, s).alias(f"{c}-{s}") for c, stats in spec for s in stats])
    return g.where("_seen").drop("_seen")


def multi_anchor_features(log: DataFrame, anchors: list[str], spec=BASE_SPEC,
                          threshold: float = TOTAL_THRES, order: list[str] | None = None) -> DataFrame:
    """Label rows of several months with their point-in-time aggregates.
    Plain statistics of numbers come from one aggregate per customer and month."""
    if all(s in STATS for _, stats in spec for s in stats):
        return _from_months(log, sorted(anchors), spec, threshold)
    last = month_start(max(anchors))
    ordered = any(s in ("first", "last") for _, stats in spec for s in stats)
    order = log_order(log, order) if ordered else []
    cols = sorted({c for c, _ in spec} | set(order) | {"customer_id", "order_date"})
    rows = explode_anchors(log.filter(F.col("order_date") < last), anchors, cols)
    return _join_all(_labels(log, anchors, threshold), [aggregate_blocks(rows, spec, order)])


def fe_baseline(log: DataFrame, ym: str, threshold: float = TOTAL_THRES, impute: bool = True) -> FeatureSet:
    """K2: 3 numeric columns x 7 stats; train at M-1, test at M; median impute
    fitted on train."""
    tr_ym = ym_shift(ym, -1)
    frame = multi_anchor_features(log, [tr_ym, ym], BASE_SPEC, threshold)
    feats = spec_names(BASE_SPEC)
    return _impute_split(FeatureSet(frame, feats, tr_ym, ym), impute)


def _impute_split(fs: FeatureSet, impute: bool) -> FeatureSet:
    if not impute:
        return fs
    # aggregated (a row per customer and anchor): written once for the null count, the medians and the fill
    fs = FeatureSet(kept(fs.frame, "features"), fs.features, fs.train_month, fs.test_month)
    tr, te, _ = median_impute(fs.train, fs.test, fs.features)
    return FeatureSet(tr.unionByName(te), fs.features, fs.train_month, fs.test_month)


def _history(log: DataFrame, ym: str, order: list[str]) -> DataFrame:
    """The columns of the log that the builders read, up to the end of month ``ym``, written once: the scans, their bounds and
    carries, labels and windows all read this narrow table instead of the log."""
    cols = dict.fromkeys(["customer_id", "order_id", "product_id", "order_date", "total", "quantity", "price", *order])
    return kept(log.filter(F.col("order_date") < month_start(ym_shift(ym, 1))).select(*cols), "log-history", compression="zstd")


def month_states(rows: DataFrame, spec, place: str = ROW_ORDER[0]) -> DataFrame:
    """One mergeable state per customer and month: moments of each column, its first and last value by place, number of rows."""
    numbers = [c for c, stats in spec if set(stats) & set(STATS)]
    ordered = [c for c, stats in spec if {"first", "last"} & set(stats)]
    return month_moments(rows, numbers, [F.count("*").alias("_rows"), *[p for c in ordered for p in ordered_parts(c, place)]])


def merged_states(states: DataFrame, anchors: list[str], spec, modes: bool = False) -> DataFrame:
    """Statistics per customer and anchor from the states of the months before it; no row of the log is repeated."""
    at = F.array(*[F.struct(F.lit(a).alias("year_month"), F.lit(ym_index(a)).alias("i")) for a in sorted(anchors)])
    rows = states.withColumn("_a", F.explode(F.filter(at, lambda a: a["i"] > F.col("_mi")))).withColumn("year_month", F.col("_a.year_month")).drop("_a")
    aggs = [merged(c, s).alias(f"{c}-{s}") for c, stats in spec for s in stats]
    if modes:
        # ties go to the smaller month
        of_year = F.array(*[F.coalesce(F.sum(F.when(F.col("_mi") % 12 == k, F.col("_rows"))), F.lit(0)) for k in range(12)])
        month = F.max_by("_mi", F.col("_rows") * 1_000_000 - F.col("_mi"))
        aggs += [F.array_position(of_year, F.array_max(of_year)).cast("int").alias("month-mode-mode"),
                 F.date_format(F.make_date(F.floor(month / 12).cast("int"), (month % 12 + 1).cast("int"), F.lit(1)), "yyyy-MM").alias("year_month-mode-mode")]
    return centred(rows, [c for c, stats in spec if set(stats) & set(STATS)], KEYS).groupBy(*KEYS).agg(*aggs)


def distinct_counts(log: DataFrame, anchors: list[str]) -> DataFrame:
    """Distinct orders and products of each customer before each anchor: a value counts from the month in which it first occurs."""
    parts = []
    for c, _ in DISTINCT_SPEC:
        firsts = log.where(F.col(c).isNotNull()).groupBy("customer_id", c).agg(F.min(month_index("order_date")).alias("_first"))
        counts = firsts.groupBy("customer_id").agg(*[F.count_if(F.col("_first") < ym_index(a)).alias(a) for a in anchors])
        long = F.explode(F.array(*[F.struct(F.lit(a).alias("year_month"), F.col(f"`{a}`").alias("n")) for a in anchors]))
        parts.append(counts.select("customer_id", long.alias("_a")).select("customer_id", "_a.year_month", F.lit(c).alias("_c"), "_a.n"))
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.groupBy(*KEYS).agg(*[F.coalesce(F.max(F.when(F.col("_c") == c, F.col("n"))), F.lit(0).cast("long")).alias(f"{c}-nunique") for c, _ in DISTINCT_SPEC])


def fe_cumulative(log: DataFrame, ym: str, threshold: float = TOTAL_THRES, impute: bool = True,
                  num_partitions: int | None = None, order: list[str] | None = None) -> FeatureSet:
    """K3: running sums by customer/product/order + raw values, 7 stats each,
    plus distinct orders and products (86 features)."""
    tr_ym = ym_shift(ym, -1)
    anchors = [tr_ym, ym]
    order = log_order(log, order)
    history = _history(log, ym, order)
    cut = history.filter(F.col("order_date") < month_start(ym))
    rows = cumsum_features(cut, order, num_partitions)
    # narrow rows are joined; the wide statistics are made beside them
    narrow = _join_all(_labels(history, anchors, threshold), [distinct_counts(cut, anchors)])
    feats = spec_names(CUMULATIVE_SPEC) + spec_names(DISTINCT_SPEC)
    frame = with_stats(narrow, rows, anchors, CUMULATIVE_SPEC).select(*KEYS, "label", *[F.col(f"`{c}`") for c in feats])
    return _impute_split(FeatureSet(frame, feats, tr_ym, ym), impute)


def full_feature_names() -> list[str]:
    from cartcast.operators.windows import WINDOW_SPEC, window_labels

    win = [f"{s}-{w}" for w in window_labels(True, True) for s in spec_names(WINDOW_SPEC)]
    return spec_names(FULL_SPEC) + spec_names(DISTINCT_SPEC + MODE_SPEC) + ["cycle_1224"] + win


def fe_full(log: DataFrame, ym: str, threshold: float = TOTAL_THRES, compat: bool = False,
            num_partitions: int | None = None, encode: bool = True, order: list[str] | None = None) -> FeatureSet:
    """K4: row features (127) + cycle_1224 + trend (168) + season (84) = 380.

    Missing values after the left joins become 0 (S12); the string mode
    ``year_month-mode-mode`` is label-encoded over train and test values.
    """
    tr_ym = ym_shift(ym, -1)
    anchors = [tr_ym, ym]
    order = log_order(log, order)
    history = _history(log, ym, order)
    cut = history.filter(F.col("order_date") < month_start(ym))
    rows = row_features(cut, order, num_partitions)
    modes = merged_states(month_states(cut, []), anchors, [], modes=True)
    if encode:
        # two narrow columns: written once for the code dictionary and the rows, so that the wide rows needn't be
        modes = kept(modes, "modes")
    # narrow rows are joined; the wide statistics are made beside them
    narrow = _join_all(_labels(history, anchors, threshold), [modes, distinct_counts(cut, anchors), cycle_1224(cut, anchors)])
    frame = with_stats(narrow, rows, anchors, FULL_SPEC, window_list(True, True), WINDOW_SPEC)
    if compat:
        frame = compat_seasons(frame)
    feats = full_feature_names()
    num = [c for c in feats if c != "year_month-mode-mode"]
    frame = frame.fillna(0.0, subset=num).fillna(0, subset=num)
    if encode:
        # the modes that reach the rows: every customer with rows before an anchor is labelled there
        frame = label_encode(frame, ["year_month-mode-mode"], modes.where(F.col("customer_id").isNotNull()), few=True)
    frame = frame.select(*KEYS, "label", *[F.col(f"`{c}`") for c in feats])
    return FeatureSet(frame, feats, tr_ym, ym)


def fe_compact(log: DataFrame, ym: str, threshold: float = TOTAL_THRES, impute: bool = True,
               num_partitions: int | None = None, order: list[str] | None = None) -> FeatureSet:
    """K5: order_ts first/last, gap mean/max and the densified cycle (5)."""
    from cartcast.operators.rowfeat import customer_scan

    tr_ym = ym_shift(ym, -1)
    anchors = [tr_ym, ym]
    order = log_order(log, order)
    history = _history(log, ym, order)
    cut = history.filter(F.col("order_date") < month_start(ym))
    rows = customer_scan(cut, order, with_cumsum=False, num_partitions=num_partitions)
    narrow = _join_all(_labels(history, anchors, threshold), [cycle_1224(cut, anchors)])
    frame = with_stats(narrow, rows, anchors, COMPACT_SPEC).select(*KEYS, "label", *[F.col(f"`{c}`") for c in spec_names(COMPACT_SPEC)], "cycle_1224")
    # densified grid: a labelled customer always has rows before its anchor,
    # so a missing cycle value means 0 spend in both months
    frame = frame.fillna(0.0, subset=["cycle_1224"])
    feats = spec_names(COMPACT_SPEC) + ["cycle_1224"]
    return _impute_split(FeatureSet(frame, feats, tr_ym, ym), impute)


CHUNK_ROWS = 1024


def description_rollups(log: DataFrame, anchors: list[str], sep: str = ", ", order: list[str] | None = None) -> DataFrame:
    """(customer_id, year_month, description): every description of a customer before each anchor joined in log order."""
    anchors = sorted(anchors)
    chunks = _chunks(log, anchors, sep, order)
    texts = F.explode(F.array(*[F.struct(F.lit(a).alias("year_month"), _upto(a, sep).alias("description")) for a in anchors]))
    return chunks.select("customer_id", texts.alias("_t")).select("customer_id", "_t.*").where(F.col("description").isNotNull())


def _upto(anchor: str, sep: str) -> Column:
    """What the chunks ``_d`` before ``anchor`` say, null if there are none."""
    earlier = F.filter("_d", lambda s: s["_mi"] < ym_index(anchor))
    return F.when(F.size(earlier) > 0, F.array_join(F.transform(earlier, lambda s: s["d"]), sep))


def _chunks(log: DataFrame, anchors: list[str], sep: str, order: list[str] | None) -> DataFrame:
    """(customer_id, _d): a customer's descriptions before the last anchor, as an array of (month, ..., joined descriptions d) in log order.

    The result of one customer is as long as its history.  Rows are placed by the skew-safe scan, chunks of ``CHUNK_ROWS`` rows of a
    month and range are joined where the scan has put them, and the last step puts together one string a chunk; all
    anchors share the pass, each cutting the list of chunks at its month.
    """
    keys = log_order(log, order)
    cut = log.filter((F.col("order_date") < month_start(max(anchors))) & F.col("description").isNotNull())
    cut = cut.select("customer_id", "description", *[c for c in keys if c not in ("customer_id", "description")], F.lit(1.0).alias("_one"))
    # written once: the scan's bounds, its carries and the rows themselves read it, and none repeats the log's joins
    cut = kept(cut, "descriptions")
    known = F.col("customer_id").isNotNull()
    placed = ordered_scan(cut.where(known), "customer_id", keys, ScanSpec(cumsum={"_rn": "_one"}), range_col="_range")
    row = F.struct(*[F.col(c).alias(f"o{k}") for k, c in enumerate(keys)], "description")
    texts, month = F.array_join(F.array_sort(F.collect_list(row))["description"], sep).alias("d"), month_index("order_date").alias("_mi")
    # ranges rise along the log's order, as chunks do
    chunks = placed.groupBy("_range", "customer_id", month, F.floor(F.col("_rn").cast("long") / CHUNK_ROWS).alias("_chunk")).agg(texts)
    # rows without a customer have no place: one chunk a month
    others = cut.where(~known).groupBy("customer_id", month).agg(texts).select("customer_id", F.struct("_mi", F.lit(0).cast("long").alias("_chunk"), F.lit(0).alias("_range"), "d").alias("_s"))
    chunks = chunks.select("customer_id", F.struct("_mi", "_chunk", "_range", "d").alias("_s")).unionByName(others)
    return chunks.groupBy("customer_id").agg(F.array_sort(F.collect_list("_s")).alias("_d"))


def customer_descriptions(log: DataFrame, ym: str, sep: str = ", ", order: list[str] | None = None) -> DataFrame:
    """Every description of a customer before ``ym`` joined in log order."""
    return description_rollups(log, [ym], sep, order).drop("year_month")


def features_with_text(fs: FeatureSet, log: DataFrame, anchor: str | None = None,
                       order: list[str] | None = None) -> DataFrame:
    """Feature rows with the description roll-up of each customer
    (before ``anchor``, default each row's own month)."""
    if anchor is not None:
        return fs.frame.join(customer_descriptions(log, anchor, order=order), "customer_id", "left")
    # a customer's chunks stay where they were put together; each of its rows takes those before its own month
    anchors, sep = sorted([fs.train_month, fs.test_month]), ", "
    rows = fs.frame.join(_chunks(log, anchors, sep, order), "customer_id", "left")
    own = F.coalesce(*[F.when(F.col("year_month") == a, _upto(a, sep)) for a in anchors])
    return rows.select(*[F.col(f"`{c}`") for c in KEYS], *[F.col(f"`{c}`") for c in fs.frame.columns if c not in KEYS], own.alias("description"))
