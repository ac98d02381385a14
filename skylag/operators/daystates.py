"""Mean distances kept up to date by periods: partial sums that merge."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skylag.operators.distances import ROUTE
from skylag.sinks.folders import read_folders, replace_folders

PERIOD = "period"
STATES = "Origin string, Dest string, total double, n long"


def _schema() -> StructType:
    return StructType.fromDDL(STATES)


def partial_states(flights: DataFrame, period: str = "FlightDate") -> DataFrame:
    """(period, Origin, Dest, total, n): sum and number of the known distances of each
    route in each period."""
    rows = flights.withColumn(PERIOD, F.col(period).cast("string"))
    return rows.groupBy(PERIOD, *ROUTE).agg(F.sum("Distance").alias("total"), F.count("Distance").alias("n"))


def put_periods(flights: DataFrame, path: str, periods: Iterable[str], period: str = "FlightDate") -> None:
    """Make the stored states of ``periods`` those of ``flights``, which must hold all
    flights of these periods. A period put again replaces what it was; one without
    flights is taken back. Flights of other periods are not read."""
    wanted = [str(p) for p in periods]
    states = partial_states(flights.where(F.col(period).cast("string").isin(wanted)), period)
    replace_folders(states, path, PERIOD, wanted, ROUTE)


def merged_distances(spark: SparkSession, path: str, periods: Iterable[str] | None = None) -> DataFrame:
    """Mean distance of each route over all stored periods, or those given: what
    ``route_distances`` gives for their flights, from one row a route and period."""
    states = read_folders(spark, path, _schema(), only=periods)
    sums = states.groupBy(*ROUTE).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    return sums.select(*ROUTE, F.try_divide("total", "n").alias("Distance"))
