"""Joins and draws under skew."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowkit.catalog.registry import query, table
from flowkit.operators import hot, side

# A third of all line items come from one supplier.
_HOT_KEY = "CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END"


def _items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr("l_orderkey", "l_linenumber", f"{_HOT_KEY} AS suppkey")


@query(f"""
    SELECT l_orderkey, l_linenumber, suppkey, s_name, s_nationkey
    FROM (SELECT l_orderkey, l_linenumber, {_HOT_KEY} AS suppkey FROM lineitem)
    LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal >= 0) ON s_suppkey = suppkey
""")
def lookup_hot_join(spark: SparkSession, folder: str) -> DataFrame:
    """A shuffled lookup join whose frequent keys are spread without adaptive execution."""
    suppliers = table(spark, folder, "supplier").where("s_acctbal >= 0").select("s_suppkey", "s_name", "s_nationkey")
    return hot.spread_join(_items(spark, folder), suppliers, ["suppkey"], ["s_suppkey"], broadcast_small=False)


@query(f"""
    SELECT suppkey, count(*) AS n FROM (SELECT {_HOT_KEY} AS suppkey FROM lineitem)
    GROUP BY suppkey HAVING count(*) >= ceil((SELECT count(*) FROM lineitem) * 0.02)
""")
def frequent_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers that at least two hundredths of the line items come from."""
    return hot.heavy_hitters(_items(spark, folder), ["suppkey"], 0.02)


@query("""
    WITH listed AS (
        SELECT c_name AS value, floor(c_acctbal)::BIGINT * 1000003 AS copies FROM customer WHERE c_acctbal >= 1
    ),
    placed AS (
        SELECT value, copies, sum(copies) OVER (ORDER BY md5(value), value) - copies AS start FROM listed
    ),
    drawn AS (
        SELECT o_orderkey, ('0x' || substr(md5(o_orderkey || ':draw'), 1, 15))::BIGINT
               % (SELECT sum(copies)::BIGINT FROM listed) AS idx
        FROM orders
    )
    SELECT o_orderkey, value AS customer FROM drawn JOIN placed ON idx >= start AND idx < start + copies
""")
def weighted_draw(spark: SparkSession, folder: str) -> DataFrame:
    """Each order draws a customer, in proportion to the customers' balances; no value is copied."""
    weight = F.floor("c_acctbal").cast("bigint") * 1_000_003
    listed = table(spark, folder, "customer").where("c_acctbal >= 1")
    values = listed.select(F.col("c_name").alias("value"), weight.alias("copies"))
    return side.draw_weighted(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey", values, "draw", "customer")
