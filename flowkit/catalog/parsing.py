"""CSV and JSON rows, and SQL over frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowkit.catalog.registry import query, table
from flowkit.functions.jsonrow import to_json_text
from flowkit.operators import parse
from flowkit.operators.sqlframe import sql_transform
from flowkit.session import scratch_dir
from flowkit.sinks.files import write_csv
from flowkit.sources.files import read_lines

_K = "json_extract_string(props, '$.k')::BIGINT"


@query("""
    SELECT c_custkey AS id, 'the "' || c_name || '", so called' AS first_name, c_mktsegment AS last_name,
           c_nationkey::VARCHAR || ',' AS email, CASE WHEN c_acctbal < 0 THEN '' ELSE 'x' END AS gender
    FROM customer
""")
def csv_typed(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as quoted CSV files with a header each, parsed back to types."""
    path = scratch_dir(spark, "csv-typed")
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lit('the "'), "c_name", F.lit('", so called')).alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.concat("c_nationkey", F.lit(",")).alias("email"),
        F.when(F.col("c_acctbal") < 0, "").otherwise("x").alias("gender"),
    )
    write_csv(customers, path)
    fields = {"id": "bigint", "first_name": "string", "last_name": "string", "email": "string", "gender": "string"}
    return parse.parse_csv_lines(read_lines(spark, path, skip_header=True), fields).rows


@query(f"SELECT event_id, {_K} AS k FROM events WHERE props IS NOT NULL")
def parse_json_rows(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return parse.parse_json_rows(events, {"k": "int"}, column="props", keep=["event_id"]).rows


@query("SELECT event_id, to_json({'event_type': event_type, 'user_id': user_id}) AS value FROM events")
def to_json_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", to_json_text("event_type", "user_id").alias("value"))


def _rides(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return parse.parse_json_rows(events, {"k": "int"}, column="props", keep=["event_type", "ts"]).rows


@query(f"""
    SELECT event_type, count(*) AS num, sum({_K})::BIGINT AS total
    FROM events WHERE NOT event_type = 'view' GROUP BY event_type
""")
def sql_filtered_agg(spark: SparkSession, folder: str) -> DataFrame:
    return sql_transform(
        _rides(spark, folder),
        """SELECT event_type, COUNT(*) AS num, SUM(k) AS total
           FROM {rows} WHERE NOT event_type = :skipped GROUP BY event_type""",
        skipped="view",
    )
