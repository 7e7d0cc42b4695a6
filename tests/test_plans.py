"""Plan properties that matter at scale (checked on the physical plan text)."""

from cartcast.operators.labels import label_month
from cartcast.operators.rowfeat import customer_scan, row_features
from cartcast.plans import features as FE
from cartcast.sources.tables import transactions
from tests.conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_month_cut_pushed_to_scan(spark):
    log = transactions(spark, SF001, description=False, country=False)
    p = _plan(label_month(log, "2001-07"))
    assert "LessThan(o_orderdate" in p or "o_orderdate < " in p
    assert "SortAggregate" not in p


def test_joins_only_for_requested_columns(spark):
    narrow = _plan(transactions(spark, SF001, description=False, country=False))
    assert "p_name" not in narrow and "n_name" not in narrow
    wide = _plan(transactions(spark, SF001))
    assert "p_name" in wide and "n_name" in wide


def test_row_feature_blocks_are_hash_aggregates(spark):
    log = transactions(spark, SF001, description=False, country=False)
    rows = customer_scan(log, num_partitions=4)
    p = _plan(FE.month_states(rows, FE.FULL_SPEC[:4]))
    assert "SortAggregate" not in p and "HashAggregate" in p


def test_scan_windows_by_range_and_key(spark):
    """Running values come from windows over (range, key), never over the possibly hot key alone, except
    among the carried totals (at most two rows a bound)."""
    log = transactions(spark, SF001, description=False, country=False)
    p = _plan(customer_scan(log, num_partitions=4))
    windows = [x for x in p.split("\n") if "Window [" in x]
    assert windows and all("[_rid" in x or "[_ckey" in x for x in windows)
    assert "ArrowEval" not in p and "MapInArrow" not in p


def test_full_builder_has_no_python_or_sort_aggregate_in_row_features(spark):
    log = transactions(spark, SF001, description=False, country=False)
    states = FE.month_states(row_features(log), FE.FULL_SPEC)
    p = _plan(FE.merged_states(states, ["2001-06", "2001-07"], FE.FULL_SPEC, modes=True))
    assert "SortAggregate" not in p and "MapInArrow" not in p


def test_full_builder_reads_the_log_once(spark):
    """The log is read when its columns are written; the plan reads that table, and repeats only rows per customer and month."""
    log = transactions(spark, SF001, description=False, country=False)
    p = FE.fe_full(log, "2001-07", encode=False).frame._jdf.queryExecution().optimizedPlan().toString()
    assert "l_quantity" not in p and "o_orderdate" not in p
    lines = p.split("\n")
    for k, x in enumerate(lines):
        if "Generate explode" in x:
            assert any("Aggregate" in y for y in lines[k + 1:k + 6]), "an explode below which no aggregate stands"


def test_no_cross_join_in_one_row_results(spark):
    import __spark_entry__ as E

    assert "CartesianProduct" not in _plan(E.queries()["eval_join"](spark, SF001))
    assert "BroadcastNestedLoopJoin" not in _plan(E.queries()["eval_join"](spark, SF001))


def test_builders_ask_for_an_order(spark):
    import pytest

    log = transactions(spark, SF001).select("order_id", "product_id", "quantity", "order_date", "price", "customer_id", "total")
    with pytest.raises(ValueError, match="order"):
        FE.fe_compact(log, "2001-07")
    assert FE.fe_baseline(log, "2001-07").frame.count() > 0


def test_windows_read_the_log_once(spark):
    """Trend windows: one aggregate over the log, by customer and month, before any row is repeated."""
    from cartcast.operators.windows import trend_features

    log = transactions(spark, SF001, description=False, country=False)
    p = trend_features(log, ["2001-06", "2001-07"])._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("lineitem") + p.count("l_orderkey") > 0 and p.count("Join") == 1
    assert "Generate explode" in p and p.index("Generate explode") < p.index("Join")


def test_the_sign_moves_to_the_join_not_the_flag(spark):
    log = transactions(spark, SF001, description=False, country=False)
    top = log._jdf.queryExecution().optimizedPlan().toString().split("\n")[0]
    assert "_sign" in top and "l_returnflag" not in top


def test_descriptions_are_joined_where_the_scan_has_put_them(spark):
    """Rows are dealt by range and customer once; no second exchange by customer, month and chunk."""
    import re

    p = _plan(FE.description_rollups(transactions(spark, SF001), ["2001-06", "2001-07"]))
    assert not re.search(r"hashpartitioning\(customer_id#\w+, _groupingexpression#\w+, _groupingexpression", p)
    assert re.search(r"hashpartitioning\(_rid#\w+, customer_id", p)


def test_texts_of_a_customer_are_not_repeated_before_the_join(spark):
    from tests.fixtures import tiny_log

    fs = FE.fe_baseline(tiny_log(spark), "2001-07")
    p = FE.features_with_text(fs, tiny_log(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "year_month, 2001-06, description" not in p and "Generate explode" not in p.split("Join")[-1]


def test_rollups_of_a_cut_customer_and_of_none(spark, monkeypatch):
    """A customer whose history is cut into ranges and chunks, others, and rows without a customer: every description once, in log order."""
    import datetime as dt

    from tests.fixtures import LOG_SCHEMA

    monkeypatch.setattr(FE, "CHUNK_ROWS", 7)
    rows, start = [], dt.datetime(2001, 1, 1)
    for i in range(1500):
        who = 1 if i % 5 < 3 else None if i % 5 == 3 else 2 + i % 11
        rows.append(("1", "2", f"d{i}" if i % 13 else None, 1.0, start + dt.timedelta(days=i // 8, hours=i % 3), 1.0, who, "X", 1.0, i, i, 1, 1, 1.0))
    log = spark.createDataFrame(rows, LOG_SCHEMA).repartition(5)
    got = {(r.customer_id, r.year_month): r.description for r in FE.description_rollups(log, ["2001-07", "2001-04"]).collect()}
    want = {}
    for ym, end in (("2001-04", dt.datetime(2001, 4, 1)), ("2001-07", dt.datetime(2001, 7, 1))):
        for r in sorted(rows, key=lambda r: (r[4], r[9])):
            if r[4] < end and r[2] is not None:
                want.setdefault((r[6], ym), []).append(r[2])
    assert got == {k: ", ".join(v) for k, v in want.items()}
