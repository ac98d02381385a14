"""From flights to training features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.functions.times import fix_overnight, parse_iso_date, schedule_ts
from skylag.schemas import FEATURES

SORT_KEYS = [
    "DayOfYear", "Carrier", "Origin", "Dest", "FlightNum", "CRSDepTime", "CRSArrTime",
]


def project_features(flights: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The columns features are made from. ``keep`` names further ones to carry."""
    return flights.select(
        "FlightNum",
        "FlightDate",
        "DayOfWeek",
        F.col("DayofMonth").alias("DayOfMonth"),
        "Carrier",
        "Origin",
        "Dest",
        "Distance",
        "DepDelay",
        "ArrDelay",
        "CRSDepTime",
        "CRSArrTime",
        *keep,
    )


def sample_flights(df: DataFrame, fraction: float, seed: int = 27) -> DataFrame:
    """A Bernoulli sample; which rows it holds depends on the partitions."""
    return df.sample(False, fraction, seed)


def drop_unknown_delays(df: DataFrame) -> DataFrame:
    return df.where(F.col("ArrDelay").isNotNull() & F.col("DepDelay").isNotNull())


def with_schedule(df: DataFrame) -> DataFrame:
    """Dates, day numbers and schedule times in their final types.

    All native expressions: the plan stays one code-generated stage from the
    scan to the sort.
    """
    dep = schedule_ts("FlightDate", "CRSDepTime")
    arr = schedule_ts("FlightDate", "CRSArrTime")
    return df.withColumns(
        {
            "DayOfYear": F.dayofyear(parse_iso_date("FlightDate")),
            "DayOfMonth": F.col("DayOfMonth").try_cast("int"),
            "DayOfWeek": F.col("DayOfWeek").try_cast("int"),
            "FlightDate": parse_iso_date("FlightDate"),
            "CRSDepTime": dep,
            "CRSArrTime": fix_overnight(dep, arr),
        }
    )


def extract_features(
    flights: DataFrame, fraction: float | None = None, seed: int = 27, keep: Sequence[str] = ()
) -> DataFrame:
    """Features in schema order. The sample is taken before unknown delays go."""
    chosen = project_features(flights, keep)
    if fraction is not None:
        chosen = sample_flights(chosen, fraction, seed)
    typed = with_schedule(drop_unknown_delays(chosen))
    return typed.select(*FEATURES.fieldNames(), *keep)


def sort_features(df: DataFrame, tie: str | None = None) -> DataFrame:
    """A total order over the seven keys, by range partitions.

    Rows equal in all keys would share one range. ``tie`` names a column that
    tells them apart (``RowKey``), which lets a large group of copies spread
    over several partitions; it is dropped afterwards.
    """
    ordered = df.orderBy(*SORT_KEYS, *([tie] if tie else []))
    return ordered.drop(tie) if tie else ordered


def alike_together(df: DataFrame) -> DataFrame:
    """Rows of each partition by the seven keys, for a file that packs like rows better.
    No row changes its partition."""
    return df.sortWithinPartitions(*SORT_KEYS)


def with_route(df: DataFrame) -> DataFrame:
    """``Route`` as Origin-Dest; NULL when either is."""
    return df.withColumn("Route", F.concat(F.col("Origin"), F.lit("-"), F.col("Dest")))


def null_profile(df: DataFrame) -> DataFrame:
    """Columns that hold NULLs, with how many. One pass for all columns."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = counts.unpivot([], df.columns, "column_name", "null_count")
    return long.where(F.col("null_count") > 0)


def preview(df: DataFrame, keys: Sequence[str], n: int = 6) -> DataFrame:
    """The first rows by ``keys``: a top-n in each partition, then one merge."""
    return df.orderBy(*keys).limit(n)
