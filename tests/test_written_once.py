"""Inputs that several jobs of a query need are computed once."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from cartcast.operators.prep import quantile_table
from cartcast.session import kept
from tests.conftest import SF001


def _reads_the_log(df) -> bool:
    return "l_orderkey" in df._jdf.queryExecution().optimizedPlan().toString()


def test_scores_labels_and_customer_statistics_are_written(spark):
    for made in (E._bin_scores, E._lab, E._cust_nulls):
        assert not _reads_the_log(made(spark, SF001)), made.__name__


def test_text_features_are_written(spark):
    assert "regexp" not in E._doc_features(spark, SF001)[0]._jdf.queryExecution().optimizedPlan().toString()


def test_quantiles_count_the_values_once(spark):
    df = spark.range(500).select((F.col("id") * 1.0).alias("a"), F.when(F.col("id") % 3 == 0, F.col("id") / 7).alias("b"))
    q = quantile_table(df, ["a", "b"], 5)
    assert "Range (0, 500" not in q._jdf.queryExecution().optimizedPlan().toString()
    assert [r.q for r in q.where("col = 'a'").orderBy("j").collect()] == [0.0, 124.75, 249.5, 374.25, 499.0]


def test_descriptions_join_the_log_once(spark):
    q = E.queries()["customer_descriptions"](spark, SF001)
    assert "p_name" not in q._jdf.queryExecution().optimizedPlan().toString()


def test_wide_rows_of_the_full_builder_are_not_written(spark, monkeypatch):
    from cartcast.plans import features as FE
    from tests.fixtures import tiny_log

    written = {}

    def record(df, name, **options):
        written[name] = len(df.columns)
        return kept(df, name, **options)

    monkeypatch.setattr(FE, "kept", record)
    fs = FE.fe_full(tiny_log(spark), "2001-07")
    assert max(written.values()) < 20, written
    # codes are those of the months among the rows, and no row lacks one
    got = sorted({r[0] for r in fs.frame.select("year_month-mode-mode").collect()})
    assert got == list(range(len(got)))


def test_labels_and_scores_read_the_log_in_one_pass(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(E, "kept", lambda df, name, **options: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or df)
    E._bin_scores(spark, SF001)
    assert plans[0].count("Relation [l_orderkey") == 1


def test_spend_of_other_months_beside_the_label(spark):
    from cartcast.operators.labels import label_month
    from tests.fixtures import tiny_log

    rows = {r.customer_id: (r.label, r.june, r.may) for r in label_month(tiny_log(spark), "2001-07", spend={"june": "2001-06", "may": "2001-05"}).collect()}
    assert rows == {1: (0, None, 50.0), 2: (1, 20.0, None), 3: (0, None, None)}
