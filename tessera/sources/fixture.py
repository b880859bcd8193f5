"""The ``sales`` working view on the test tables.

lineitem ⋈ part ⋈ orders with derived columns that play the roles of the
house-sale attributes (target, facility codes with nulls, a group key, a
graded code, a rare flag, a near copy, a constant). Nulls are injected by
arithmetic rules so Spark and DuckDB build the same view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import read_table

# Row key of the view: unique at every scale of the test data.
KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_from(read_table(spark, sf_dir, "lineitem"), spark, sf_dir)


def sales_from(li: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view over any lineitem frame (batch or stream) and the static
    part and orders tables."""
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    joined = (li.join(part, li.l_partkey == part.p_partkey)
              .join(orders, li.l_orderkey == orders.o_orderkey))
    net = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return joined.select(
        *[F.col(c) for c in KEY],
        "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        "l_shipdate", "p_brand", "p_type", "p_size", "p_retailprice",
        "o_orderdate", "o_orderpriority", "o_totalprice",
        F.when(F.col("l_orderkey") % 2 == 0, "train").otherwise("test").alias("split"),
        net.alias("net"),
        F.log(1 + net).alias("y"),
        F.when((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 6 == 0, None)
        .otherwise(F.col("p_size").cast("double")).alias("frontage"),
        F.when(F.col("l_partkey") % 5 == 0, None).otherwise(F.col("p_type")).alias("facility"),
        F.when(F.col("l_suppkey") % 9 == 0, None).otherwise(F.col("l_quantity")).alias("extra_qty"),
        F.when(F.col("l_orderkey") % 101 == 0, None)
        .otherwise(F.col("o_orderpriority")).alias("priority_n"),
        F.month("l_shipdate").cast("string").alias("month_s"),
        F.when(F.col("l_partkey") % 50 == 0, 1).otherwise(0).alias("rare"),
        (F.col("l_extendedprice") * 1.1 + F.col("l_linenumber")).alias("price_copy"),
        F.lit(1).alias("const_one"),
        (F.year("l_shipdate") - F.year("o_orderdate")).alias("age"),
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training half with its target."""
    return sales(spark, sf_dir).filter(F.col("split") == "train")


def unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring half: the target columns are not part of it."""
    return sales(spark, sf_dir).filter(F.col("split") == "test").drop("net", "y")


# The same view for the DuckDB oracle, as a WITH prefix.
SALES_CTE = """
WITH sales AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_extendedprice,
         l.l_quantity, l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus, l.l_shipdate,
         p.p_brand, p.p_type, p.p_size, p.p_retailprice,
         o.o_orderdate, o.o_orderpriority, o.o_totalprice,
         CASE WHEN l.l_orderkey % 2 = 0 THEN 'train' ELSE 'test' END AS split,
         l.l_extendedprice * (1 - l.l_discount) * (1 + l.l_tax) AS net,
         ln(1 + l.l_extendedprice * (1 - l.l_discount) * (1 + l.l_tax)) AS y,
         CASE WHEN (l.l_orderkey * 7 + l.l_linenumber) % 6 = 0 THEN NULL
              ELSE CAST(p.p_size AS DOUBLE) END AS frontage,
         CASE WHEN l.l_partkey % 5 = 0 THEN NULL ELSE p.p_type END AS facility,
         CASE WHEN l.l_suppkey % 9 = 0 THEN NULL ELSE l.l_quantity END AS extra_qty,
         CASE WHEN l.l_orderkey % 101 = 0 THEN NULL ELSE o.o_orderpriority END AS priority_n,
         CAST(month(l.l_shipdate) AS VARCHAR) AS month_s,
         CASE WHEN l.l_partkey % 50 = 0 THEN 1 ELSE 0 END AS rare,
         l.l_extendedprice * 1.1 + l.l_linenumber AS price_copy,
         1 AS const_one,
         CAST(year(l.l_shipdate) - year(o.o_orderdate) AS INTEGER) AS age
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
                  JOIN orders o ON l.l_orderkey = o.o_orderkey
)
"""

KEY_SQL = ", ".join(KEY)
