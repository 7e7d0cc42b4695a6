"""Table access and the transaction-log view over the star-schema test tables.

The log has the columns of the reference's ``train.csv`` plus the raw line keys
that give it a total order (contract S1):

    order_id string, product_id string, description string, quantity double,
    order_date timestamp_ntz, price double, customer_id bigint, country string,
    total double, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice

Joins are added only for the columns asked for: ``description`` needs ``part``,
``country`` needs ``customer`` and ``nation``.  Catalyst cannot drop an inner
join by itself (it knows no foreign keys), so skipping them here saves two
shuffles of the fact table for every builder that does not use them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Total order of log rows (file order of the reference), unique at every scale.
LOG_ORDER = ["order_date", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _sign() -> Column:
    return F.when(F.col("l_returnflag") == "R", F.lit(-1)).otherwise(F.lit(1))


def order_id_expr() -> Column:
    k = F.col("l_orderkey").cast("string")
    return F.when(F.col("_sign") < 0, F.concat(F.lit("C"), k)).otherwise(k)


def product_id_expr() -> Column:
    pk = F.col("l_partkey")
    s = pk.cast("string")
    return (F.when(pk % 50 == 0, F.lit("M"))
            .when(pk % 7 == 0, F.concat(s, F.lit("A")))
            .otherwise(s))


def transactions(spark: SparkSession, sf_dir: str, description: bool = True,
                 country: bool = True) -> DataFrame:
    """The transaction log (FIXTURES §2) as a lazy DataFrame."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", _sign().cast("byte").alias("_sign"))  # what moves to the join is a number, not the flag's text
    od = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate")
    df = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    if description:
        pt = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
        df = df.join(pt, df.l_partkey == pt.p_partkey, "inner")
    if country:
        cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        na = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
        df = (df.join(cu, df.o_custkey == cu.c_custkey, "inner")
                .join(na, F.col("c_nationkey") == na.n_nationkey, "inner"))
    sgn = F.col("_sign").cast("int")
    cols = [
        order_id_expr().alias("order_id"),
        product_id_expr().alias("product_id"),
    ]
    if description:
        cols.append(F.col("p_name").alias("description"))
    cols += [
        (F.col("l_quantity") * sgn).cast("double").alias("quantity"),
        F.col("o_orderdate").alias("order_date"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("price"),
        F.col("o_custkey").alias("customer_id"),
    ]
    if country:
        cols.append(F.col("n_name").alias("country"))
    cols += [
        (F.col("l_extendedprice") * sgn).cast("double").alias("total"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
    ]
    return df.select(*cols)
