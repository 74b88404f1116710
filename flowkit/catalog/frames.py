"""Lookup joins, top-k, side inputs, routing and CSV sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowkit.catalog.registry import query, table
from flowkit.functions.times import epoch_seconds, parse_day
from flowkit.operators import joins, split, topk
from flowkit.plans import frame_jobs
from flowkit.plans.text_jobs import draw_groups
from flowkit.session import scratch_dir
from flowkit.sinks.files import append_table, write_csv
from flowkit.sources.files import distinct_values, group_ids, read_csv, read_table
from flowkit.streaming.windows import tumbling_count

# Suppliers in debt are not listed, so some line items find no supplier.
_LISTED = "s_acctbal >= 0"
_LOOKUP_SUM = f"""
    SELECT s_nationkey, sum(l_quantity::BIGINT)::BIGINT AS l_quantity
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    WHERE {_LISTED} AND s_nationkey IS NOT NULL GROUP BY s_nationkey
"""


def _suppliers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").where(_LISTED)


def _lookup_sum(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem").withColumn("l_quantity", F.col("l_quantity").cast("bigint"))
    return joins.lookup_sum(items, _suppliers(spark, folder), "l_suppkey", "s_suppkey", "s_nationkey", "l_quantity")


@query(f"""
    SELECT l_orderkey, l_linenumber, l_suppkey, s_name, s_nationkey
    FROM lineitem LEFT JOIN (SELECT * FROM supplier WHERE {_LISTED}) ON l_suppkey = s_suppkey
""")
def lookup_left_join(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    suppliers = _suppliers(spark, folder).select("s_suppkey", "s_name", "s_nationkey")
    return joins.lookup_join(items, suppliers, "l_suppkey", "s_suppkey")


@query(_LOOKUP_SUM)
def lookup_enrich_sum(spark: SparkSession, folder: str) -> DataFrame:
    return _lookup_sum(spark, folder)


@query(_LOOKUP_SUM)
def csv_lookup_enrich_sum(spark: SparkSession, folder: str) -> DataFrame:
    """The same from CSV files, as rides and zones come."""
    items, suppliers = scratch_dir(spark, "items"), scratch_dir(spark, "suppliers")
    lines = table(spark, folder, "lineitem").select("l_suppkey", F.col("l_quantity").cast("bigint"))
    write_csv(lines, items)
    write_csv(_suppliers(spark, folder).select("s_suppkey", "s_nationkey"), suppliers)
    return joins.lookup_sum(
        read_csv(spark, items, "l_suppkey bigint, l_quantity bigint"),
        read_csv(spark, suppliers, "s_suppkey bigint, s_nationkey int"),
        "l_suppkey",
        "s_suppkey",
        "s_nationkey",
        "l_quantity",
    )


@query(_LOOKUP_SUM)
def sink_roundtrip_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "sums")
    write_csv(_lookup_sum(spark, folder), path)
    return read_csv(spark, path, "s_nationkey int, l_quantity bigint")


@query("""
    SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 7 = 1 THEN ''
      ELSE repeat(' ', (doc_id % 3)::INT) || text || repeat(' ', (doc_id % 2)::INT) END AS text
    FROM documents
""")
def csv_roundtrip_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with line ends, blanks around them, empty and missing ones, through exact CSV files."""
    blanks = lambda n: F.expr(f"repeat(' ', CAST(doc_id % {n} AS INT))")
    odd = F.when(F.col("doc_id") % 7 == 0, None).when(F.col("doc_id") % 7 == 1, "")
    path = scratch_dir(spark, "exact")
    texts = table(spark, folder, "documents").select(
        "doc_id", odd.otherwise(F.concat(blanks(3), "text", blanks(2))).alias("text")
    )
    write_csv(texts, path, exact=True)
    return read_csv(spark, path, "doc_id bigint, text string", exact=True)


@query("""
    SELECT o_orderkey::VARCHAR AS id, o_orderpriority[1:1] AS level FROM orders
    WHERE o_orderkey IS NOT NULL AND o_orderpriority IS NOT NULL AND TRY_CAST(o_orderpriority[1:1] AS INT) IS NULL
    UNION ALL
    SELECT 'x' || o_orderkey, o_orderpriority[1:1] FROM orders
    WHERE o_orderkey % 5 = 0 AND TRY_CAST(o_orderpriority[1:1] AS INT) IS NOT NULL
""")
def append_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of which a fifth has a key that is no number: what does not fit the table comes back."""
    level = F.substring("o_orderpriority", 1, 1)
    key = F.col("o_orderkey").cast("string")
    broken = (F.col("o_orderkey") % 5 == 0) & level.try_cast("int").isNotNull()
    orders = table(spark, folder, "orders").select(
        F.when(broken, F.concat(F.lit("x"), key)).otherwise(key).alias("id"), level.alias("level")
    )
    schema = StructType.fromDDL("id bigint, level int")
    return append_table(orders, schema, path=scratch_dir(spark, "orders"), strict=False)


@query("SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def sink_append_table(spark: SparkSession, folder: str) -> DataFrame:
    """Customers of two market groups, appended one after the other."""
    path = scratch_dir(spark, "customers")
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    building = F.coalesce(F.col("c_mktsegment") == "BUILDING", F.lit(False))
    for part in (customers.where(building), customers.where(~building)):
        append_table(part, customers.schema, path=path)
    return spark.read.schema(customers.schema).parquet(path)


@query("""
    SELECT o_custkey, a.n + b.n AS n
    FROM (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) a
    JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) b USING (o_custkey)
""")
def aligned_count_sum(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    urgent, done = orders.where("o_orderpriority = '1-URGENT'"), orders.where("o_orderstatus = 'F'")
    return joins.aligned_count_sum(urgent, done, "o_custkey")


@query("""
    SELECT p_partkey, p_brand, p_size
    FROM (SELECT *, rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS place FROM part)
    WHERE place <= 3
""")
def top_k_ties(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select("p_partkey", "p_brand", "p_size")
    return topk.top_k_ties(parts, ["p_brand"], "p_size", 3)


@query("""
    SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9000)
""")
def semi_join_members(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    rich = table(spark, folder, "customer").where("c_acctbal > 9000")
    return joins.keep_members(orders, "o_custkey", rich, "c_custkey")


_HUB_MEANS = """
    a AS (SELECT period, airline, dest AS hub, count(*) AS n FROM f GROUP BY ALL),
    d AS (SELECT period, airline, origin AS hub, count(*) AS n FROM f GROUP BY ALL),
    t AS (
        SELECT period, airline, hub, rank() OVER (PARTITION BY period, airline ORDER BY a.n + d.n DESC) AS place
        FROM a JOIN d USING (period, airline, hub)
    )
    SELECT f.period AS {period}, f.airline AS {airline},
           avg(CASE WHEN hub IS NOT NULL THEN x END)::DOUBLE AS {x},
           avg(CASE WHEN hub IS NOT NULL THEN y END)::DOUBLE AS {y}
    FROM f LEFT JOIN t ON f.period = t.period AND f.airline = t.airline AND dest = hub AND place <= 10
    GROUP BY f.period, f.airline
"""
_TRIPS = """
    lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
"""


def _trips(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as trips from the customer's nation to the supplier's."""
    items = table(spark, folder, "lineitem").join(table(spark, folder, "orders"), F.expr("l_orderkey = o_orderkey"))
    items = items.join(table(spark, folder, "customer"), F.expr("o_custkey = c_custkey"))
    return items.join(table(spark, folder, "supplier"), F.expr("l_suppkey = s_suppkey"))


@query(f"""
    WITH f AS (
        SELECT strftime(time_bucket(INTERVAL 30 DAY, o_orderdate, TIMESTAMP '1970-01-01'), '%Y-%m-%d') AS period,
               o_orderpriority AS airline, c_nationkey AS origin, s_nationkey AS dest,
               date_diff('day', o_orderdate, l_shipdate) AS x, l_quantity AS y
        FROM {_TRIPS}
    ), {_HUB_MEANS.format(period="period", airline="o_orderpriority", x="lag_days", y="quantity")}
""")
def top_hub_mean(spark: SparkSession, folder: str) -> DataFrame:
    trips = _trips(spark, folder).select(
        F.window("o_orderdate", "30 days").getField("start").alias("period"),
        "o_orderpriority",
        "c_nationkey",
        "s_nationkey",
        F.datediff("l_shipdate", "o_orderdate").cast("double").alias("lag_days"),
        F.col("l_quantity").alias("quantity"),
    )
    means = topk.top_hub_mean(
        trips, ["period", "o_orderpriority"], "c_nationkey", "s_nationkey", ["lag_days", "quantity"], 10
    )
    return means.withColumn("period", F.col("period").cast("date").cast("string"))


@query(f"""
    WITH f AS (
        SELECT strftime(o_orderdate + INTERVAL 3653 DAY, '%Y-%m-%d') AS period, o_orderpriority AS airline,
               'N' || c_nationkey AS origin, 'N' || s_nationkey AS dest,
               l_quantity AS x, date_diff('day', o_orderdate, l_shipdate) AS y
        FROM {_TRIPS} WHERE l_returnflag <> 'N'
    ), {_HUB_MEANS.format(period="day", airline="airline", x="departure_delay", y="arrival_delay")}
    HAVING f.period BETWEEN '2006-03-01' AND '2010-12-31'
""")
def flight_delays(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as flights ten years later; some have no departure delay."""
    flights = _trips(spark, folder).select(
        F.date_add("o_orderdate", 3653).alias("FlightDate"),
        F.col("o_orderpriority").alias("IATA_CODE_Reporting_Airline"),
        F.concat(F.lit("N"), "c_nationkey").alias("Origin"),
        F.concat(F.lit("N"), "s_nationkey").alias("Dest"),
        F.when(F.col("l_returnflag") != "N", F.col("l_quantity")).alias("DepDelay"),
        F.datediff("l_shipdate", "o_orderdate").alias("ArrDelay"),
    )
    return frame_jobs.flight_delays(flights, "2006-03-01", "2010-12-31")


@query("""
    SELECT strftime(time_bucket(INTERVAL 1 DAY, o_orderdate), '%Y-%m-%d') AS day,
           epoch(time_bucket(INTERVAL 1 DAY, o_orderdate))::BIGINT AS starts, o_orderpriority, count(*) AS n
    FROM orders GROUP BY ALL
""")
def daily_window_agg(spark: SparkSession, folder: str) -> DataFrame:
    daily = tumbling_count(table(spark, folder, "orders"), "o_orderpriority", "o_orderdate", "1 day")
    day = F.col("window_start").cast("date").cast("string")
    return daily.select(day.alias("day"), epoch_seconds(parse_day(day)).alias("starts"), "o_orderpriority", "n")


@query("""
    SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderpriority AS priority,
           o_custkey::VARCHAR AS customer, o_totalprice AS price
    FROM orders
    WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate <= TIMESTAMP '1996-12-31'
      AND o_custkey IS NOT NULL AND o_totalprice IS NOT NULL
""")
def source_projection_filter(spark: SparkSession, folder: str) -> DataFrame:
    first, last = (F.lit(day).cast("timestamp_ntz") for day in ("1995-01-01", "1996-12-31"))
    return read_table(
        table(spark, folder, "orders"),
        {
            "id": "o_orderkey",
            "date": F.date_format("o_orderdate", "yyyy-MM-dd"),
            "priority": "o_orderpriority",
            "customer": F.col("o_custkey").cast("string"),
            "price": F.col("o_totalprice").cast("double"),
        },
        F.col("o_orderdate").between(first, last),
        ["o_custkey", "o_totalprice"],
    )


_DRAW = """
    SELECT {value}, row_number() OVER (ORDER BY md5({value}), {value}) - 1 AS idx,
           count(*) OVER () AS size
    FROM (SELECT DISTINCT {value} FROM {table}) WHERE {value} <> '' AND {value} <> '{ignore}'
"""
_NUMBER = "('0x' || substr(md5('id' || i || ':{seed}'), 1, 15))::BIGINT"


@query(f"""
    WITH corpora AS ({_DRAW.format(value="source", table="documents", ignore="src0")}),
         words AS ({_DRAW.format(value="p_name", table="part", ignore="red widget")}),
         ids AS (
             SELECT 'id' || i AS group_id,
                    {_NUMBER.format(seed="7-corpus")} % (SELECT max(size) FROM corpora) AS c,
                    {_NUMBER.format(seed="7-word")} % (SELECT max(size) FROM words) AS w
             FROM (SELECT row_number() OVER () - 1 AS i FROM orders)
         )
    SELECT group_id, corpora.source AS corpus, p_name AS word
    FROM ids JOIN corpora ON corpora.idx = c JOIN words ON words.idx = w
""")
def side_input_groups(spark: SparkSession, folder: str) -> DataFrame:
    """As many groups as there are orders."""
    ids = group_ids(spark, table(spark, folder, "orders").count())
    corpora = distinct_values(table(spark, folder, "documents"), "source")
    words = distinct_values(table(spark, folder, "part"), "p_name")
    return draw_groups(ids, "group_id", corpora, words, "src0", "red widget", seed=7)


@query("""
    SELECT l_orderkey, l_linenumber, l_quantity - (SELECT avg(l_quantity) FROM lineitem) AS above_mean
    FROM lineitem
""")
def side_input_scalar(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem")
    mean = joins.single_value(items.agg(F.avg("l_quantity").alias("mean")), "mean")
    return items.select("l_orderkey", "l_linenumber", (F.col("l_quantity") - mean).alias("above_mean"))


@query("""
    SELECT c_nationkey AS nation, c_acctbal AS balance FROM customer
    UNION ALL SELECT s_nationkey, s_acctbal FROM supplier
    UNION ALL SELECT c_nationkey, c_acctbal FROM customer
""")
def union_all(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").selectExpr("c_nationkey AS nation", "c_acctbal AS balance")
    suppliers = table(spark, folder, "supplier").selectExpr("s_acctbal AS balance", "s_nationkey AS nation")
    return split.union_all(customers, suppliers, customers)


@query("""
    SELECT p_partkey,
           CASE WHEN p_size > 40 THEN 'large' WHEN p_retailprice >= 1000 THEN 'dear' ELSE 'plain' END AS kind
    FROM part
""")
def partition_by_features(spark: SparkSession, folder: str) -> DataFrame:
    """Parts with the first condition they meet, in one pass over them."""
    kinds = {"large": F.expr("p_size > 40"), "dear": F.expr("p_retailprice >= 1000"), "plain": F.lit(True)}
    return table(spark, folder, "part").transform(split.with_route, kinds, "kind").select("p_partkey", "kind")


@query("""
    SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderkey % 2 = 0 AS even,
           CASE WHEN o_custkey % 5 > 0 THEN o_custkey END AS customer, o_orderpriority AS priority,
           'bigint,double,date,boolean,bigint,string,string' AS types
    FROM orders
""")
def csv_inferred(spark: SparkSession, folder: str) -> DataFrame:
    """A hundred CSV files whose types are found while they are read; one column is empty in all of them."""
    orders = table(spark, folder, "orders").selectExpr(
        "o_orderkey + 3000000000 AS key", "o_totalprice AS price", "date_format(o_orderdate, 'yyyy-MM-dd') AS day",
        "o_orderkey % 2 = 0 AS even", "IF(o_custkey % 5 > 0, o_custkey + 3000000000, NULL) AS customer",
        "o_orderpriority AS priority", "CAST(NULL AS STRING) AS nothing",
    )
    path = scratch_dir(spark, "hundred")
    write_csv(orders.repartitionByRange(100, "key"), path)
    rows = read_csv(spark, path, infer=True)
    return rows.select(
        (F.col("key") - 3_000_000_000).alias("o_orderkey"),
        F.col("price").alias("o_totalprice"),
        F.col("day").cast("string").alias("day"),
        "even",
        (F.col("customer") - 3_000_000_000).alias("customer"),
        "priority",
        F.lit(",".join(t for _, t in rows.dtypes)).alias("types"),
    )
