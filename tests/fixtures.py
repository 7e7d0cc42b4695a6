"""Hand-made tables (FIXTURES.md §3)."""

import datetime as dt

from pyspark.sql import types as T

LOG_SCHEMA = T.StructType([
    T.StructField("order_id", T.StringType()), T.StructField("product_id", T.StringType()),
    T.StructField("description", T.StringType()), T.StructField("quantity", T.DoubleType()),
    T.StructField("order_date", T.TimestampNTZType()), T.StructField("price", T.DoubleType()),
    T.StructField("customer_id", T.LongType()), T.StructField("country", T.StringType()),
    T.StructField("total", T.DoubleType()),
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_partkey", T.LongType()), T.StructField("l_suppkey", T.LongType()),
    T.StructField("l_extendedprice", T.DoubleType()),
])


def d(y, m, day=1):
    return dt.datetime(y, m, day)


def tiny_log(spark):
    """4 customers over 2001-03..2001-07; customer 4 first buys in the target month."""
    rows = []
    spec = [
        # cust, date, qty, price, order
        (1, d(2001, 3, 5), 2.0, 100.0, 10), (1, d(2001, 3, 5), -1.0, 100.0, 10), (1, d(2001, 5, 2), 1.0, 50.0, 11),
        (1, d(2001, 7, 3), 3.0, 100.0, 12),                        # spend 300 in 2001-07: not > 300
        (2, d(2001, 4, 1), 1.0, 20.0, 20), (2, d(2001, 6, 9), 2.0, 10.0, 21), (2, d(2001, 7, 9), 4.0, 80.0, 22),
        (2, d(2001, 7, 10), 1.0, 0.5, 23),                         # 320.5 in 2001-07: label 1
        (3, d(2001, 2, 1), 5.0, 1.0, 30), (3, d(2001, 2, 1), 5.0, 1.0, 30), (3, d(2001, 2, 1), 5.0, 1.0, 31),
        (4, d(2001, 7, 1), 9.0, 100.0, 40),                        # new in target month: no label row
        (2, d(2001, 8, 1), 1.0, 1.0, 24),
    ]
    for i, (c, when, q, p, o) in enumerate(spec):
        oid = ("C" if q < 0 else "") + str(o)
        rows.append((oid, str(100 + i % 4), f"item {i % 4}", q, when, p, c, "X", q * p,
                     o, i, 100 + i % 4, 1, abs(q * p) + i * 1e-3))
    return spark.createDataFrame(rows, LOG_SCHEMA)
