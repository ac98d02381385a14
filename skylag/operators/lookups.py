"""Searches, point lookups and pages over the flight and airplane tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skylag.functions.text import matched_words, query_words
from skylag.operators import text_index
from skylag.operators.summaries import fleet_counts

# Rows on one page.
FLIGHTS_PER_PAGE = 15
AIRPLANES_PER_PAGE = 5

FLIGHT_FIELDS = ["Carrier", "FlightDate", "Origin", "Dest", "TailNum", "FlightNum"]
AIRPLANE_FIELDS = [
    "TailNum", "Owner", "OwnerState", "Manufacturer", "Model", "ManufacturerYear",
    "SerialNumber", "EngineManufacturer", "EngineModel",
]
FLIGHT_ORDER = ["FlightDate", "DepTime", "Carrier", "FlightNum"]
AIRPLANE_ORDER = ["Owner"]

def _check_fields(given: dict, allowed: Sequence[str]) -> dict:
    unknown = set(given) - set(allowed)
    if unknown:
        raise ValueError(f"unknown search fields: {sorted(unknown)}")
    return {name: value for name, value in given.items() if value}


def search_flights(flights: DataFrame, **fields: str | None) -> DataFrame:
    """Flights that agree in every field given; fields left out do not count."""
    wanted = _check_fields(fields, FLIGHT_FIELDS)
    return reduce(lambda df, kv: df.where(F.col(kv[0]) == kv[1]), wanted.items(), flights)


def search_airplanes(airplanes: DataFrame, **fields: str | None) -> DataFrame:
    """Airplanes that share a word with every field given, scored by ``Relevance``.

    The score is the number of words matched, a simple stand-in for the formula
    of a search server.
    """
    wanted = _check_fields(fields, AIRPLANE_FIELDS)
    wanted = {name: value for name, value in wanted.items() if query_words(value)}
    scores = [matched_words(F.col(name), value) for name, value in wanted.items()]
    hits = reduce(lambda df, score: df.where(score > 0), scores, airplanes)
    relevance = reduce(lambda a, b: a + b, scores, F.lit(0))
    return hits.withColumn("Relevance", relevance)


def get_flight(flights: DataFrame, carrier: str, flight_date: str, flight_num: str) -> DataFrame:
    """One flight; of several that fit, the first by all columns."""
    fits = search_flights(
        flights, Carrier=carrier, FlightDate=flight_date, FlightNum=flight_num
    )
    return fits.orderBy(*flights.columns).limit(1)


def list_flights(flights: DataFrame, origin: str, dest: str, flight_date: str) -> DataFrame:
    """Flights of a route on a day by departure and arrival, each with the count."""
    found = search_flights(flights, Origin=origin, Dest=dest, FlightDate=flight_date)
    order = _order(found.columns, ["DepTime", "ArrTime"], ())
    return with_total(found, found).orderBy(*order)


def airplane_flights(
    fleet: DataFrame, tail_number: str, start: int = 0, size: int = FLIGHTS_PER_PAGE
) -> DataFrame:
    """A page of the flights of one tail number, from the per-airplane table, by date
    and number. The filter reaches a table stored by TailNum."""
    return page(fleet.where(F.col("TailNum") == tail_number), ["FlightDate", "FlightNum"], start, size)


def airline_page(airlines: DataFrame, fleets: DataFrame, carrier: str | None = None) -> DataFrame:
    """Carrier summaries, one row each, beside the size of their fleets; a carrier
    without fleet stays. The airplanes are listed by ``fleet_page``."""
    if carrier:
        airlines = airlines.where(F.col("CarrierCode") == carrier)
        fleets = fleets.where(F.col("Carrier") == carrier)
    counts = fleet_counts(fleets)
    return airlines.join(counts, F.col("CarrierCode") == F.col("Carrier"), "left").drop("Carrier")


def fleet_page(
    fleets: DataFrame, carrier: str, start: int = 0, size: int = AIRPLANES_PER_PAGE
) -> DataFrame:
    """A page of the tail numbers of one carrier."""
    return page(fleets.where(F.col("Carrier") == carrier), ["TailNum"], start, size)


def list_carriers(fleets: DataFrame) -> DataFrame:
    """All carriers that have airplanes, each once with the size of its fleet."""
    return fleet_counts(fleets)


def day_range(column: str, day: str) -> Column:
    """Text between a day and the next, both ends included."""
    next_day = F.date_add(F.lit(day).cast("date"), 1).cast("string")
    return F.col(column).between(F.lit(day), next_day)


def on_day(df: DataFrame, day: str, column: str = "Timestamp") -> DataFrame:
    return df.where(day_range(column, day))


def with_total(rows: DataFrame, counted: DataFrame, name: str = "total") -> DataFrame:
    """``rows`` with the number of rows in ``counted`` beside each.

    The count is an aggregate of its own, which reads the filter columns only;
    a window over everything would bring all rows into one task.
    """
    return rows.withColumn(name, counted.agg(F.count(F.lit(1)).alias("n")).scalar())


def _order(columns: Sequence[str], keys: Sequence[str], descending: Sequence[str]) -> list[Column]:
    """By ``keys``, then by all other columns, so that the order is total."""
    rest = [c for c in columns if c not in keys]
    return [F.col(c).desc() if c in descending else F.col(c).asc() for c in [*keys, *rest]]


def page(
    df: DataFrame, keys: Sequence[str], start: int, size: int, descending: Sequence[str] = ()
) -> DataFrame:
    """``size`` rows from row ``start`` on, ordered by ``keys`` and then by all other columns.

    A plain top-n, which brings the rows before the page together. To read pages far
    down, store the order once with ``write_order`` and use ``stored_page``.
    """
    return df.orderBy(*_order(df.columns, keys, descending)).offset(start).limit(size)


def search_after(
    df: DataFrame, keys: Sequence[str], last: dict, size: int, descending: Sequence[str] = ()
) -> DataFrame:
    """The ``size`` rows that follow the row ``last`` (all its columns) in the order of
    ``page``: the next page without the ones before it. Copies of ``last`` are skipped.
    """
    after, same = F.lit(False), F.lit(True)
    for name in [*keys, *[c for c in df.columns if c not in keys]]:
        c, value = F.col(name), F.lit(last[name])
        if name in descending:  # NULL comes last
            later = F.lit(False) if last[name] is None else (c < value) | c.isNull()
        else:  # NULL comes first
            later = c.isNotNull() if last[name] is None else c > value
        after = after | (same & F.coalesce(later, F.lit(False)))
        same = same & c.eqNullSafe(value)
    return page(df.where(after), keys, 0, size, descending)


def write_order(df: DataFrame, path: str, keys: Sequence[str], descending: Sequence[str] = ()) -> None:
    """Store ``df`` in order for ``stored_page``: in ranges of the keys and all other
    columns, numbered by ``_range``, equal rows folded into one with their number ``_n``.
    """
    folded = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    order = _order(df.columns, keys, descending)
    ranges = folded.repartitionByRange(*order).sortWithinPartitions(*order)
    ranges.withColumn("_range", F.spark_partition_id()).write.mode("overwrite").parquet(path)


def stored_page(
    spark: SparkSession, path: str, keys: Sequence[str], start: int, size: int,
    descending: Sequence[str] = (),
) -> DataFrame:
    """The same rows as ``page``, from a stored order.

    The rows of each range are counted, one number a range, and only the ranges the
    page touches are read; within each, running counts find the rows.
    """
    stored = spark.read.parquet(path)
    columns = [c for c in stored.columns if c not in ("_n", "_range")]
    before, touched = 0, []
    for number, rows in sorted(stored.groupBy("_range").agg(F.sum("_n")).collect()):
        if before < start + size and before + rows > start:
            touched.append((number, before))
        before += rows
    order = _order(columns, keys, descending)
    inside = stored.where(F.col("_range").isin([number for number, _ in touched]))
    offset = F.coalesce(*[F.when(F.col("_range") == n, b) for n, b in touched], F.lit(0))
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    upto = (F.sum("_n").over(within) + offset).alias("_upto")
    found = inside.select("*", upto).where((F.col("_upto") > start) & (F.col("_upto") - F.col("_n") < start + size))
    shown = F.least("_upto", F.lit(start + size)) - F.greatest(F.col("_upto") - F.col("_n"), F.lit(start))
    copies = found.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), shown)))
    return copies.select(*columns).orderBy(*order)


def flights_page(
    flights: DataFrame, start: int = 0, size: int = FLIGHTS_PER_PAGE, **fields: str | None
) -> DataFrame:
    """One page of a flight search, with the number of all hits."""
    hits = search_flights(flights, **fields)
    return with_total(page(hits, FLIGHT_ORDER, start, size), hits)


def airplanes_page(
    airplanes: DataFrame, start: int = 0, size: int = AIRPLANES_PER_PAGE, **fields: str | None
) -> DataFrame:
    """One page of an airplane search by owner, best matches first."""
    hits = search_airplanes(airplanes, **fields)
    order = [*AIRPLANE_ORDER, "Relevance"]
    return with_total(page(hits, order, start, size, descending=["Relevance"]), hits)


def index_airplanes(airplanes: DataFrame, path: str) -> None:
    """Store the index for the searches below, over all fields, by tail number."""
    text_index.build_index(airplanes, path, "TailNum", AIRPLANE_FIELDS)


def indexed_airplanes(
    spark: SparkSession, path: str, airplanes: DataFrame, **fields: str | None
) -> DataFrame:
    """The airplanes of ``search_airplanes``, found and scored by the index; without
    any words to look for, all of them with a score of 0."""
    wanted = _check_fields(fields, AIRPLANE_FIELDS)
    if not any(query_words(value) for value in wanted.values()):
        return airplanes.withColumn("Relevance", F.lit(0.0))
    return text_index.with_documents(text_index.hits(spark, path, **wanted), airplanes, "TailNum")


def indexed_airplanes_page(
    spark: SparkSession, path: str, airplanes: DataFrame, start: int = 0,
    size: int = AIRPLANES_PER_PAGE, **fields: str | None,
) -> DataFrame:
    """One page of an indexed search by owner, best matches first."""
    hits = indexed_airplanes(spark, path, airplanes, **fields)
    order = [*AIRPLANE_ORDER, "Relevance"]
    return with_total(page(hits, order, start, size, descending=["Relevance"]), hits)


def best_airplanes(
    spark: SparkSession, path: str, airplanes: DataFrame, n: int, **fields: str | None
) -> DataFrame:
    """The ``n`` airplanes that match best, ties by tail number."""
    wanted = _check_fields(fields, AIRPLANE_FIELDS)
    return text_index.top(spark, path, airplanes, "TailNum", n, **wanted)


def page_bounds(df: DataFrame, start: int, end: int, size: int, total: str = "total") -> DataFrame:
    """A page with the offsets of its neighbours, never below 0, and whether each
    neighbour is worth a link: it starts before the last row and ends above 0."""
    bounds = {
        "next_bottom": F.lit(start + size),
        "next_top": F.lit(end + size),
        "previous_bottom": F.greatest(F.lit(start - size), F.lit(0)),
        "previous_top": F.greatest(F.lit(end - size), F.lit(0)),
    }
    rows = df.withColumns(bounds)
    return rows.withColumns(
        {
            f"{side}_link": (F.col(f"{side}_top") > 0) & (F.col(total) > F.col(f"{side}_bottom"))
            for side in ("next", "previous")
        }
    )
