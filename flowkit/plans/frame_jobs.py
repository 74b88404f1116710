"""Jobs over tables: lookup sums and delays at busy airports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowkit.functions.times import check_day, event_time, utc_day
from flowkit.operators.joins import lookup_sum
from flowkit.operators.topk import top_hub_mean
from flowkit.sinks.files import write_csv
from flowkit.sources.files import read_csv, read_table

# The columns of a flights table under the names used here, and
# the first and last day it holds.
FLIGHT_COLUMNS = {
    "date": "FlightDate",
    "airline": "IATA_CODE_Reporting_Airline",
    "departure_airport": "Origin",
    "arrival_airport": "Dest",
    "departure_delay": "DepDelay",
    "arrival_delay": "ArrDelay",
}
FIRST_DAY, LAST_DAY = date(2002, 1, 1), date(2012, 12, 31)
TOP_AIRPORTS = 10


def run_passengers_per_borough(
    spark: SparkSession,
    input: str,
    zone_lookup: str,
    output: str,
    ride_schema: StructType | str | None = None,
    zone_schema: StructType | str | None = None,
) -> None:
    """Ride files and a zone file to passengers dropped off per borough.

    Without a schema the key and the borough are text, the passengers numbers of any kind.
    """
    rides, zones = read_csv(spark, input, ride_schema), read_csv(spark, zone_lookup, zone_schema)
    count = F.col("passenger_count")
    if ride_schema is None:
        rides = rides.withColumn("passenger_count", count.cast("double"))
    sums = lookup_sum(rides, zones, "DOLocationID", "LocationID", "Borough", "passenger_count")
    if ride_schema is None:
        whole = F.when(count == F.floor(count), F.floor(count).cast("string")).otherwise(count.cast("string"))
        sums = sums.withColumn("passenger_count", whole)
    write_csv(sums, output)


def flight_delays(flights: DataFrame, start_date: str, end_date: str) -> DataFrame:
    """Mean delays per day and airline over flights to the airline's busiest airports.

    Both dates are included. ``flights`` has the columns ``FLIGHT_COLUMNS`` names.
    """
    for day in (start_date, end_date):
        check_day(day, FIRST_DAY, LAST_DAY)
    chosen = read_table(
        flights,
        FLIGHT_COLUMNS,
        F.col("FlightDate").between(F.lit(start_date), F.lit(end_date)),
        ["DepDelay", "ArrDelay"],
    )
    # A missing name becomes the text None, as casting it to text does there.
    names = {c: F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in list(FLIGHT_COLUMNS)[1:4]}
    delays = {c: F.col(c).cast("double") for c in ("departure_delay", "arrival_delay")}
    zoned = dict(chosen.dtypes)["date"] == "timestamp"
    day = utc_day(event_time(F.col("date"))) if zoned else F.col("date").cast("date")
    daily = chosen.withColumns({**names, **delays}).withColumn("day", day)
    means = top_hub_mean(
        daily, ["day", "airline"], "departure_airport", "arrival_airport", list(delays), TOP_AIRPORTS
    )
    return means.withColumn("day", F.col("day").cast("string"))


def run_flight_delays(
    flights: DataFrame, output: str, start_date: str = "2012-12-22", end_date: str = "2012-12-26"
) -> None:
    write_csv(flight_delays(flights, start_date, end_date), output)
