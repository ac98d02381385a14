"""The given star-schema tables read as flights, airplanes, airlines, requests
and responses, so that every query runs over whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag.sources.tables import spread, with_row_key


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hhmm(minute: Column) -> Column:
    clock = F.floor(minute / 60) * 100 + minute % 60
    return F.when(minute == 0, F.lit("2400")).otherwise(
        F.lpad(clock.cast("string"), 4, "0")
    )


def _code(letter: str, number: Column, width: int = 2) -> Column:
    return F.concat(F.lit(letter), F.lpad(number.cast("string"), width, "0"))


def flights(spark: SparkSession, sf_dir: str, row_key: bool = False) -> DataFrame:
    """One flight for each line item, from the supplier's nation to the customer's.

    No side is marked for broadcast: the planner broadcasts what it measures as
    small and sorts the rest, and skewed keys are split at run time. With
    ``row_key`` each row carries the ``RowKey`` of its line item.
    """
    line = table(spark, sf_dir, "lineitem")
    line = (with_row_key(line) if row_key else line).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate",
        *(["RowKey"] if row_key else []),
    )
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("sn"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("cn"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "cn")

    minute = F.col("l_orderkey") * 7 + F.col("l_linenumber") * 131
    number = F.col("l_orderkey") + F.col("l_linenumber")
    dep_delay = F.when(number % 41 != 0, F.col("l_quantity") - 10)
    arr_delay = F.when(
        number % 43 != 0, F.col("l_quantity") - 10 + (F.col("l_partkey") % 61) - 30
    )
    rows = (
        line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            "*",
            F.to_date("l_shipdate").alias("fd"),
            (minute % 1440).cast("int").alias("dm"),
            ((minute + 45 + F.col("l_suppkey") % 300) % 1440).cast("int").alias("am"),
            dep_delay.alias("DepDelay"),
            arr_delay.alias("ArrDelay"),
        )
    )

    def shifted(m: str, delay: str) -> Column:
        return _hhmm((F.col(m) + F.col(delay).cast("int") + 1440) % 1440)

    distance = 100 + ((F.col("sn") * 37 + F.col("cn") * 53) % 25) * 100 + F.col("l_linenumber") % 3
    return rows.select(
        F.year("fd").alias("Year"),
        F.month("fd").alias("Month"),
        F.dayofmonth("fd").alias("DayofMonth"),
        (F.weekday("fd") + 1).alias("DayOfWeek"),
        F.col("fd").cast("string").alias("FlightDate"),
        F.concat(F.lit("C"), F.expr("substr(p_brand, 7)")).alias("Carrier"),
        _code("N", F.col("l_partkey") % 500, 5).alias("TailNum"),
        (F.col("l_orderkey") % 9000 + 1).cast("string").alias("FlightNum"),
        _code("A", F.col("sn")).alias("Origin"),
        _code("A", F.col("cn")).alias("Dest"),
        distance.cast("double").alias("Distance"),
        "DepDelay",
        "ArrDelay",
        _hhmm(F.col("dm")).alias("CRSDepTime"),
        _hhmm(F.col("am")).alias("CRSArrTime"),
        F.when(F.col("DepDelay").isNotNull(), shifted("dm", "DepDelay")).alias("DepTime"),
        F.when(F.col("ArrDelay").isNotNull(), shifted("am", "ArrDelay")).alias("ArrTime"),
        (distance.cast("double") / 8).alias("AirTime"),
        *(["RowKey"] if row_key else []),
    )


def airplanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry of airplanes behind the tail numbers."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.format_string("N%05d", key).alias("TailNum"),
        F.col("p_name").alias("Owner"),
        F.concat(F.lit("S"), F.col("p_size") % 5).alias("OwnerState"),
        F.concat(F.lit("Maker "), F.expr("substr(p_brand, 7)")).alias("Manufacturer"),
        F.col("p_type").alias("Model"),
        (1980 + F.col("p_size") % 40).cast("string").alias("ManufacturerYear"),
        F.concat(F.lit("S"), key).alias("SerialNumber"),
        F.concat(F.lit("Engine "), key % 7).alias("EngineManufacturer"),
        F.concat(F.lit("E"), key % 11).alias("EngineModel"),
    )


def airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each carrier code."""
    brands = table(spark, sf_dir, "part").select("p_brand").distinct()
    named = brands.select(
        F.concat(F.lit("C"), F.expr("substr(p_brand, 7)")).alias("CarrierCode"),
        F.col("p_brand").alias("Name"),
    )
    domain = F.concat(F.lower("CarrierCode"), F.lit(".example"))
    return named.select(
        "*",
        F.concat(F.lit("http://"), domain).alias("url"),
        domain.alias("domain"),
        F.concat(F.lit("http://"), domain, F.lit("/logo.png")).alias("logo_url"),
        F.concat(F.lit("Carrier "), F.col("CarrierCode")).alias("summary"),
    )


def requests(spark: SparkSession, sf_dir: str, keep: Sequence[str] = ()) -> DataFrame:
    """Prediction requests as a form sends them, with the event time in ``ts``.

    One destination in 26 is a place no flight goes to. ``keep`` names further
    columns of the events to carry.
    """
    e = table(spark, sf_dir, "events").select(*dict.fromkeys(["event_id", "user_id", "ts", "value", *keep]))
    event, user = F.col("event_id"), F.col("user_id")
    return spread(e).select(
        F.md5(event.cast("string")).alias("UUID"),
        _code("A", user % 25).alias("Origin"),
        _code("A", (user * 7 + event) % 26).alias("Dest"),
        F.concat(F.lit("C"), event % 25 + 1).alias("Carrier"),
        (event % 9000 + 1).cast("string").alias("FlightNum"),
        F.to_date("ts").cast("string").alias("FlightDate"),
        (F.col("value") - 15).alias("DepDelay"),
        F.replace(F.date_trunc("second", "ts").cast("string"), F.lit(" "), F.lit("T")).alias(
            "Timestamp"
        ),
        "ts",
        *keep,
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers to all requests, 0 to 29 seconds later."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.md5(F.col("event_id").cast("string")).alias("UUID"),
        (F.col("ts") + F.make_dt_interval(secs=(F.col("event_id") % 30).cast("decimal(18,6)"))).alias("ts"),
        (F.col("event_id") % 4).cast("double").alias("Prediction"),
    )


def mixed_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers to match: one in seven requests has none; the others have theirs twice,
    another one 4 seconds later, and one 40 seconds earlier, mostly before its request.
    Each has a prediction of its own."""
    e = table(spark, sf_dir, "events").where(F.col("event_id") % 7 != 0).select("event_id", "ts")
    shifts = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(p).alias("p")) for s, p in ((0, 0), (0, 0), (4, 1), (-40, 2))])
    # The id is made once for all answers to a request.
    e = spread(e).withColumn("UUID", F.md5(F.col("event_id").cast("string"))).withColumn("shift", F.explode(shifts))
    seconds = (F.col("event_id") % 30 + F.col("shift.s")).cast("decimal(18,6)")
    return e.select(
        "UUID",
        (F.col("ts") + F.make_dt_interval(secs=seconds)).alias("ts"),
        ((F.col("event_id") + F.col("shift.p")) % 4).cast("double").alias("Prediction"),
    )
