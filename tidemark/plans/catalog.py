"""Registry of the reference-shaped queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a (spark, sf_dir) function under a query name, with its oracle SQL if it has one."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query name: {name}")
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "w02_latest_per_group",
    """
    SELECT o_custkey, o_orderpriority, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date, c_name
    FROM (
      SELECT o.*, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS rn
      FROM orders o) t
    LEFT JOIN customer ON c_custkey = o_custkey
    WHERE rn = 1
    """,
)
def latest_per_group_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window as W
    from pyspark.sql import functions as F

    newest = W.partitionBy("o_custkey", "o_orderpriority").orderBy(F.desc_nulls_last("o_orderdate"), F.desc("o_orderkey"))
    orders = table(spark, sf_dir, "orders").withColumn("rn", F.row_number().over(newest)).where("rn = 1")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return orders.join(customer, orders.o_custkey == customer.c_custkey, "left").select(
        "o_custkey", "o_orderpriority", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"), "c_name"
    )
