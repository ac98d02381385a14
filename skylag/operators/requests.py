"""Prediction requests: typed fields, derived features, matching responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylag.functions.times import date_parts
from skylag.operators.distances import ROUTE, with_distance

# The fields of a request form and their types.
FORM_FIELDS = {
    "DepDelay": "double",
    "Carrier": "string",
    "FlightDate": "string",
    "Dest": "string",
    "FlightNum": "string",
    "Origin": "string",
}
REGRESSION_FIELDS = {**FORM_FIELDS, "DepDelay": "int"}


def coerce_request(df: DataFrame, fields: dict[str, str] = FORM_FIELDS) -> DataFrame:
    """Form fields in their types; what cannot be read becomes NULL."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in fields.items()})


def with_date_parts(df: DataFrame, column: str = "FlightDate") -> DataFrame:
    return df.withColumns(date_parts(column))


def prepare_requests(
    forms: DataFrame,
    distances: DataFrame,
    on_missing: str = "error",
    uuid: Column | None = None,
    timestamp: Column | None = None,
    fields: dict[str, str] = FORM_FIELDS,
) -> DataFrame:
    """Form values to complete requests: typed, with distance, date parts, time and id.

    By default the time is now, in UTC as messages are read, and the id random. Write the result before using
    it twice: a random id is drawn anew whenever a row is computed again.
    """
    known = with_distance(coerce_request(forms, fields), distances, on_missing)
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    now = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return with_date_parts(known).withColumns(
        {
            "Timestamp": now if timestamp is None else timestamp,
            "UUID": F.uuid() if uuid is None else uuid,
        }
    )


def without_distance(forms: DataFrame, distances: DataFrame) -> DataFrame:
    """The forms, as given, whose route has no distance."""
    return forms.join(distances.select(*ROUTE), ROUTE, "left_anti").select(*forms.columns)


def match_responses(
    requests: DataFrame, responses: DataFrame, wait: str = "20 seconds"
) -> DataFrame:
    """Each request as ``OK`` with the prediction of its earliest answer, or ``WAIT``.

    A response counts from the moment of the request until ``wait`` later; one that
    came before, or too late, does not hide another one in time. A request sent again
    with the same id and time is one request. Equal responses are folded before they
    meet the requests, and of those that meet one the earliest is kept by a minimum,
    which is combined before its shuffle.
    """
    folded = responses.groupBy(F.col("UUID").alias("_id"), F.col("ts").alias("_at")).agg(
        F.min("Prediction").alias("_prediction")
    )
    asked = requests.select("UUID", "ts").distinct()
    until = F.col("ts") + F.expr(f"INTERVAL {wait}")
    in_time = (F.col("UUID") == F.col("_id")) & F.col("_at").between(F.col("ts"), until)
    met = asked.join(folded, in_time, "left").groupBy("UUID", "ts").agg(earliest_answer())
    return answered(met).drop("ts")


def earliest_answer() -> Column:
    """The first answer of a group of rows with ``_at`` and ``_prediction``; of equal
    times the smaller prediction. NULL where a request met none."""
    answer = F.struct("_at", "_prediction")
    return F.min(F.when(F.col("_at").isNotNull(), answer)).alias("_first")


def answered(met: DataFrame) -> DataFrame:
    """Status and prediction of requests beside their earliest answers."""
    return met.select(
        "UUID",
        "ts",
        F.when(F.col("_first").isNotNull(), "OK").otherwise("WAIT").alias("status"),
        F.col("_first._prediction").alias("Prediction"),
    )
