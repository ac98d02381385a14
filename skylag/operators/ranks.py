"""Places of rows in an order, and indexes of values by frequency, without a window
over all rows and without the values on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylag.session import materialise


def ranked(rows: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """``rows`` with their place from 0 in ``order``.

    The rows are sorted by ranges; a row's place is its place in its range plus the
    rows of the ranges before, of which there is one number each. Rows that are equal
    in ``order`` are spread, so their places are arbitrary among them.
    """
    spread = rows.withColumn("_place", F.monotonically_increasing_id())
    parts = spread.repartitionByRange(*order, "_place").sortWithinPartitions(*order, "_place").drop("_place")
    # The number has the partition in its upper bits, the place in it below.
    parts = materialise(parts.withColumn("_at", F.monotonically_increasing_id()), "ranks")
    parts = parts.withColumn("_part", F.shiftright("_at", 33))
    counts = parts.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    # A row for each range: as many as the shuffle has partitions.
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = materialise(counts.select("_part", "_first", F.coalesce(before, F.lit(0)).alias("_before")), "offsets")
    placed = parts.join(offsets, "_part")
    rank = F.col("_before") + F.col("_at") - F.col("_first")
    return placed.withColumn(name, rank).drop("_part", "_at", "_first", "_before")


def frequency_index(rows: DataFrame, column: str, name: str = "position") -> DataFrame:
    """(column, name): the values of a column from 0 by falling frequency, ties by
    value; what a string indexer gives, for columns of any number of values. NULL has
    no index."""
    counts = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_count"))
    places = ranked(counts, [F.desc("_count"), F.asc(column)], name)
    return places.select(column, F.col(name).cast("double").alias(name))


def with_index(
    rows: DataFrame, index: DataFrame, column: str, name: str, handle_invalid: str = "keep"
) -> DataFrame:
    """``rows`` with the index of their value in ``name``.

    Unseen and missing values get the index after the last (``keep``), are left out
    (``skip``) or stop the job (``error``). A frequent value is split over tasks.
    """
    held = index.select(F.col(index.columns[0]).alias("_value"), F.col(index.columns[1]).alias("_index"))
    if handle_invalid == "skip":
        return rows.join(held, F.col(column) == F.col("_value")).withColumn(name, F.col("_index")).drop("_value", "_index")
    met = rows.join(held, F.col(column) == F.col("_value"), "left").drop("_value")
    if handle_invalid == "error":
        other = F.raise_error(F.concat(F.lit(f"no index of {column} for "), F.coalesce(F.col(column), F.lit("NULL")))).cast("double")
    elif handle_invalid == "keep":
        after = index.agg(F.count("*").cast("double").alias("n")).scalar()
        other = after
    else:
        raise ValueError(f"unknown handle_invalid: {handle_invalid}")
    return met.withColumn(name, F.when(F.col("_index").isNotNull(), F.col("_index")).otherwise(other)).drop("_index")
