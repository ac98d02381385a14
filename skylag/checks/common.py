"""Helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylag.functions.times import date_parts
from skylag.operators import distances as dist
from skylag.operators import features as feat
from skylag.operators import model
from skylag.session import materialise, tune, work_path
from skylag.sinks import files
from skylag.sources import tables, testbed

# Models trained in this process, by application and input.
_MODELS: dict[tuple[str, str], object] = {}


def flights(spark: SparkSession, sf_dir: str, row_key: bool = False) -> DataFrame:
    return testbed.flights(tune(spark), sf_dir, row_key)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.extract_features(flights(spark, sf_dir))


def distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dist.route_distances(flights(spark, sf_dir))


def stored_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distance table written and read back, as scoring jobs find it: its size
    is known, so requests are not shuffled to meet a small table."""
    path = work_path(spark, "distances")
    files.write_clustered(distances(spark, sf_dir), path, dist.ROUTE)
    return tables.read_distances(spark, path)


def full_requests(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Requests with date parts, as messages carry them."""
    rows = testbed.requests(tune(spark), sf_dir, keep)
    return rows.withColumns(date_parts("FlightDate"))


def times_as_text(df: DataFrame) -> DataFrame:
    """Dates and times as text, so that engines cannot differ in type alone."""
    timed = (T.DateType, T.TimestampType, T.TimestampNTZType)
    casts = {
        f.name: F.col(f.name).cast("string")
        for f in df.schema.fields
        if isinstance(f.dataType, timed)
    }
    return df.withColumns(casts) if casts else df


def stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(features(spark, sf_dir), "features")


def trained(spark: SparkSession, sf_dir: str):
    """The classifier fitted on all flights of ``sf_dir``, once for each session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS:
        path = work_path(spark, "model")
        model.save_model(model.train(stored_features(spark, sf_dir)), path)
        _MODELS[key] = path
    return model.for_serving(model.load_model(_MODELS[key]))
