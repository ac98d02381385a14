"""Counts, histograms and the per-airplane and per-carrier documents.

The pages only show these tables; how they are aggregated follows from the
shape they show.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FLIGHT_ENTRY = ["FlightDate", "FlightNum", "Carrier", "Origin", "Dest"]

def class_counts(df: DataFrame, column: str = "Prediction") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def month_counts(flights: DataFrame) -> DataFrame:
    return flights.groupBy("Year", "Month").agg(F.count(F.lit(1)).alias("total_flights"))


def flights_by_month(flights: DataFrame) -> DataFrame:
    """Flights of each year and month, in order."""
    return month_counts(flights).orderBy("Year", "Month")


def flights_per_airplane(flights: DataFrame) -> DataFrame:
    """The flights of each tail number, a row for each different one, with ``Copies``.

    Kept as rows, not as one array a key, so that an airplane of any number of flights
    is spread over tasks and files. Store it with ``write_clustered`` by TailNum and
    read one airplane page by page, see ``lookups.airplane_flights``.
    """
    return flights.groupBy("TailNum", *FLIGHT_ENTRY).agg(F.count(F.lit(1)).alias("Copies"))


def airplanes_per_carrier(flights: DataFrame) -> DataFrame:
    """The fleet of each carrier: a row (Carrier, TailNum) for each airplane."""
    return flights.where(F.col("TailNum").isNotNull()).select("Carrier", "TailNum").distinct()


def fleet_counts(fleets: DataFrame) -> DataFrame:
    """(Carrier, FleetCount) of the rows of ``airplanes_per_carrier``."""
    return fleets.groupBy("Carrier").agg(F.count("TailNum").alias("FleetCount"))


def manufacturer_totals(airplanes: DataFrame) -> DataFrame:
    """Airplanes of each manufacturer, one row each."""
    return airplanes.groupBy("Manufacturer").agg(F.count(F.lit(1)).alias("Total"))


def chart_rows(totals: DataFrame, label: str, value: str) -> DataFrame:
    """The bars of a chart, largest first, ties by label."""
    return totals.orderBy(F.desc(value), label)


def delay_histogram(
    flights: DataFrame, edges: Sequence[float], column: str = "ArrDelay"
) -> DataFrame:
    """How many flights fall between neighbouring edges: (label, value).

    Bins are closed on the left and open-ended on both sides; unknown delays
    are not counted. A bin nothing falls into has 0.
    """
    c = F.col(column)
    labels = [f"< {edges[0]:g}"]
    place = F.when(c < edges[0], 0)
    for number, (low, high) in enumerate(zip(edges, edges[1:]), 1):
        labels.append(f"{low:g} to {high:g}")
        place = place.when(c < high, number)
    labels.append(f">= {edges[-1]:g}")
    place = place.otherwise(len(edges))
    found = flights.where(c.isNotNull()).groupBy(place.alias("_bin")).agg(F.count(F.lit(1)).alias("value"))
    bins = flights.sparkSession.createDataFrame(list(enumerate(labels)), "_bin int, label string")
    return bins.join(found, "_bin", "left").select("label", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
