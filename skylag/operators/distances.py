"""Route distances: build the table, keep it, and join requests to it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUTE = ["Origin", "Dest"]


def route_distances(flights: DataFrame) -> DataFrame:
    """Mean distance of each (Origin, Dest).

    Partial sums are formed before the shuffle, so a busy route costs one row
    for each map task.
    """
    return flights.groupBy(*ROUTE).agg(F.avg("Distance").alias("Distance"))


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def by_distance(distances: DataFrame, ascending: bool = True) -> DataFrame:
    """Routes by distance, ties by name. For the longest ``n`` add ``.limit(n)``."""
    first = F.col("Distance").asc() if ascending else F.col("Distance").desc()
    return distances.orderBy(first, *ROUTE)


def select_distances(df: DataFrame, *keep: str) -> DataFrame:
    """The three columns of the distance table, and those to ``keep``; a missing
    distance is 0.0."""
    return df.select(
        F.col("Origin"),
        F.col("Dest"),
        F.coalesce(F.col("Distance").cast("double"), F.lit(0.0)).alias("Distance"),
        *keep,
    )


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The last row of each key by ``order``, remaining columns breaking ties.

    A maximum over structs, not a window: it is combined before the shuffle, so
    a key that is written over and over does not land in one task.
    """
    values = [c for c in df.columns if c not in keys and c not in order]
    ranked = F.max(F.struct(*order, *values)).alias("last")
    rows = df.groupBy(*keys).agg(ranked)
    return rows.select(*keys, *[F.col(f"last.{c}").alias(c) for c in values + list(order)])


def upsert(
    stored: DataFrame, changes: DataFrame, keys: Sequence[str], seq: str | None = None
) -> DataFrame:
    """``stored`` with ``changes`` put in by key; the last write wins.

    ``seq`` orders several changes of the same key. The result is a new table:
    write it next to the old one and switch, or use MERGE INTO where the table
    format has it.
    """
    order = [seq] if seq else []
    old = stored.withColumn("_write", F.lit(0))
    new = changes.withColumn("_write", F.lit(1))
    if seq and seq not in stored.columns:
        old = old.withColumn(seq, F.lit(None).cast(changes.schema[seq].dataType))
    both = old.unionByName(new.select(*old.columns))
    latest = latest_per_key(both, keys, ["_write", *order])
    return latest.select(*stored.columns)


def route_distance(distances: DataFrame, origin: str, dest: str) -> DataFrame:
    """The distance of one route; no row when the route is unknown."""
    known = (F.col("Origin") == origin) & (F.col("Dest") == dest)
    return distances.where(known).select("Distance")


def with_distance(
    requests: DataFrame, distances: DataFrame, on_missing: str = "zero"
) -> DataFrame:
    """Look up the distance of each request's route.

    ``on_missing``: ``zero`` keeps the request with 0.0, ``drop`` leaves it out,
    ``error`` stops the job. The distance table has one row for each route, so
    rows never multiply. No broadcast hint: the planner broadcasts the table
    while its measured size is under ``spark.sql.autoBroadcastJoinThreshold``
    and otherwise joins by sorting, splitting busy routes.
    """
    lookup = distances.select(*ROUTE, "Distance")
    plain = requests.drop("Distance")
    if on_missing == "drop":
        return plain.join(lookup, ROUTE, "inner")
    joined = plain.join(lookup, ROUTE, "left")
    if on_missing == "zero":
        return joined.na.fill({"Distance": 0.0})
    if on_missing == "error":
        return joined.withColumn("Distance", _required("Distance"))
    raise ValueError(f"unknown on_missing: {on_missing}")


def _required(column: str) -> Column:
    route = F.concat_ws("-", *[F.col(c) for c in ROUTE])
    return F.when(F.col(column).isNotNull(), F.col(column)).otherwise(
        F.raise_error(F.concat(F.lit("no distance for route "), route)).cast("double")
    )


def routes_without_distance(requests: DataFrame, distances: DataFrame) -> DataFrame:
    """Routes asked for that the distance table lacks: a check before ``error``."""
    return requests.select(*ROUTE).distinct().join(distances, ROUTE, "left_anti")
