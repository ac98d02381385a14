"""Registered queries: scans, features and indexes."""

from __future__ import annotations

from pyspark.sql import functions as F

from skylag.checks import sql
from skylag.checks.common import (
    features, flights, full_requests, stored_distances, stored_features, times_as_text, trained,
)
from skylag.operators import distances as dist
from skylag.operators import features as feat
from skylag.operators import model, ranks
from skylag.operators.summaries import class_counts
from skylag.session import materialise, work_path
from skylag.sinks import files
from skylag.sources import tables

QUERIES = {}
ORACLE = {}


def scan_flights(spark, sf_dir):
    """Column choice and view by SQL text."""
    tables.register(spark, flights(spark, sf_dir), "on_time_performance")
    return spark.sql(
        "SELECT FlightDate, Carrier, FlightNum, Origin, Dest, TailNum, AirTime, DepTime, ArrTime "
        "FROM on_time_performance"
    )


QUERIES["scan_flights"] = scan_flights
ORACLE["scan_flights"] = f"""WITH {sql.FLIGHTS}
SELECT "FlightDate", "Carrier", "FlightNum", "Origin", "Dest", "TailNum", "AirTime", "DepTime", "ArrTime"
FROM flights"""


def feature_extraction(spark, sf_dir):
    rows = feat.extract_features(flights(spark, sf_dir, row_key=True), keep=["RowKey"])
    return times_as_text(feat.sort_features(rows, tie="RowKey"))


QUERIES["feature_extraction"] = feature_extraction
ORACLE["feature_extraction"] = f"WITH {sql.FEATURES} SELECT * FROM features"


def json_roundtrip(spark, sf_dir):
    """Write bzip2 JSON lines, read them back with the fixed schema."""
    path = work_path(spark, "features-json")
    files.write_json(feat.alike_together(features(spark, sf_dir)), path, compression="bzip2")
    return times_as_text(tables.read_features(spark, path))


QUERIES["json_roundtrip"] = json_roundtrip
ORACLE["json_roundtrip"] = ORACLE["feature_extraction"]


def sample_flights(spark, sf_dir):
    """Of each month: all flights with known delays, how many sampled ones are none of
    them, and whether a tenth was drawn, give or take four standard deviations."""
    rows = flights(spark, sf_dir)
    known = materialise(times_as_text(feat.extract_features(rows)), "known")
    drawn = materialise(times_as_text(feat.extract_features(rows, fraction=0.1)), "sample")
    month = F.substring("FlightDate", 1, 7).alias("month")
    outside = drawn.join(known, known.columns, "left_anti").groupBy(month).agg(F.count("*").alias("outside"))
    sizes = drawn.groupBy(month).agg(F.count("*").alias("n"))
    months = known.groupBy(month).agg(F.count("*").alias("flights"))
    found = months.join(sizes, "month", "left").join(outside, "month", "left").na.fill(0)
    fits = F.abs(F.col("n") - 0.1 * F.col("flights")) <= 4 * F.sqrt(0.09 * F.col("flights")) + 1
    return found.select("month", "flights", "outside", fits.alias("fits"))


QUERIES["sample_flights"] = sample_flights
ORACLE["sample_flights"] = f"""WITH {sql.FEATURES}
SELECT substr(CAST("FlightDate" AS VARCHAR), 1, 7) AS month, count(*) AS flights,
  CAST(0 AS BIGINT) AS outside, true AS fits FROM features GROUP BY 1"""


def null_profile(spark, sf_dir):
    return feat.null_profile(flights(spark, sf_dir))


QUERIES["null_profile"] = null_profile
ORACLE["null_profile"] = f"WITH {sql.FLIGHTS}, counts AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE \"{c}\" IS NULL) AS null_count FROM flights"
    for c in sql.FLIGHT_COLUMNS
) + ") SELECT * FROM counts WHERE null_count > 0"


def with_route(spark, sf_dir):
    return feat.with_route(flights(spark, sf_dir)).select("FlightNum", "FlightDate", "Carrier", "Route")


QUERIES["with_route"] = with_route
ORACLE["with_route"] = f"""WITH {sql.FLIGHTS}
SELECT "FlightNum", "FlightDate", "Carrier", concat("Origin", '-', "Dest") AS "Route" FROM flights"""


def delay_buckets(spark, sf_dir):
    rows = model.delay_bucket(flights(spark, sf_dir))
    return rows.select("Carrier", "FlightNum", "FlightDate", "ArrDelay", "ArrDelayBucket")


QUERIES["delay_buckets"] = delay_buckets
ORACLE["delay_buckets"] = f"""WITH {sql.FLIGHTS}
SELECT "Carrier", "FlightNum", "FlightDate", "ArrDelay", {sql.bucket('"ArrDelay"')} AS "ArrDelayBucket"
FROM flights"""


def bucket_counts(spark, sf_dir):
    rows = model.delay_bucket(flights(spark, sf_dir).where(F.col("ArrDelay").isNotNull()))
    return class_counts(rows, "ArrDelayBucket")


QUERIES["bucket_counts"] = bucket_counts
ORACLE["bucket_counts"] = f"""WITH {sql.FLIGHTS}
SELECT {sql.bucket('"ArrDelay"')} AS "ArrDelayBucket", count(*) AS "count"
FROM flights WHERE "ArrDelay" IS NOT NULL GROUP BY 1"""


def preview(spark, sf_dir):
    rows = features(spark, sf_dir)
    rest = [c for c in sorted(rows.columns) if c != "CRSDepTime"]
    return times_as_text(feat.preview(rows, ["CRSDepTime", *rest], 6))


QUERIES["preview"] = preview
ORACLE["preview"] = f"""WITH {sql.FEATURES} SELECT * FROM features
ORDER BY "CRSDepTime", {sql.cols([c for c in sorted(sql.FEATURE_COLUMNS) if c != "CRSDepTime"])} LIMIT 6"""


def request_date_parts(spark, sf_dir):
    return full_requests(spark, sf_dir).select(
        "UUID", "FlightDate", "DayOfYear", "DayOfMonth", "DayOfWeek"
    )


QUERIES["request_date_parts"] = request_date_parts
ORACLE["request_date_parts"] = f"""WITH {sql.REQUESTS}
SELECT "UUID", "FlightDate", "DayOfYear", "DayOfMonth", "DayOfWeek" FROM requests"""


# Indexes: each label with the number the fitted indexer gives it.

_ROUTED = f"""{sql.FEATURES},
routed AS (SELECT *, concat("Origin", '-', "Dest") AS "Route" FROM features)"""


def _index_query(column):
    def query(spark, sf_dir):
        rows = feat.with_route(features(spark, sf_dir))
        fitted = model.StringIndexer(inputCol=column, outputCol="position").fit(rows)
        labels = class_counts(rows, column).select(F.col(column))
        return fitted.transform(labels).select(F.col(column).alias("label"), "position")

    return query


for _column in model.INDEXED:
    _name = f"{_column.lower()}_index"
    QUERIES[_name] = _index_query(_column)
    ORACLE[_name] = f"""WITH {_ROUTED},
counted AS (SELECT "{_column}" AS label, count(*) AS n FROM routed GROUP BY 1)
SELECT label, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS DOUBLE) AS position FROM counted"""


def frequency_index(spark, sf_dir):
    """The route index by ranges, without labels on the driver."""
    return ranks.frequency_index(feat.with_route(features(spark, sf_dir)), "Route").withColumnRenamed("Route", "label")


QUERIES["frequency_index"] = frequency_index
ORACLE["frequency_index"] = ORACLE["route_index"]


def indexed_features(spark, sf_dir):
    """The vectors of ``feature_vectors`` as columns, their indexes joined from tables."""
    rows = model.training_rows(stored_features(spark, sf_dir))
    for column, name in zip(model.INDEXED, model.INDEX_COLUMNS, strict=True):
        rows = ranks.with_index(rows, materialise(ranks.frequency_index(rows, column), "index"), column, name)
    return rows.select(*[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(model.VECTOR_COLUMNS)], model.LABEL)


QUERIES["indexed_features"] = indexed_features


def feature_vectors(spark, sf_dir):
    """All nine numbers of each vector, with the class."""
    from pyspark.ml.functions import vector_to_array

    rows = model.training_rows(stored_features(spark, sf_dir))
    indexed = model.index_columns(rows).transform(rows)
    vectors = model.assemble(indexed).select(
        vector_to_array(model.VECTOR).alias("v"), model.LABEL
    )
    return vectors.select(
        *[F.col("v")[i].alias(f"f{i}") for i in range(len(model.VECTOR_COLUMNS))], model.LABEL
    )


QUERIES["feature_vectors"] = feature_vectors
ORACLE["feature_vectors"] = (
    f"WITH {_ROUTED}, "
    + ", ".join(
        f"""i_{c.lower()} AS (SELECT label, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS DOUBLE) AS i
FROM (SELECT "{c}" AS label, count(*) AS n FROM routed GROUP BY 1))"""
        for c in model.INDEXED
    )
    + f"""
SELECT "DepDelay" AS f0, "Distance" AS f1, CAST("DayOfMonth" AS DOUBLE) AS f2,
  CAST("DayOfWeek" AS DOUBLE) AS f3, CAST("DayOfYear" AS DOUBLE) AS f4,
  i_carrier.i AS f5, i_origin.i AS f6, i_dest.i AS f7, i_route.i AS f8,
  {sql.bucket('"ArrDelay"')} AS "ArrDelayBucket"
FROM routed
JOIN i_carrier ON routed."Carrier" = i_carrier.label
JOIN i_origin ON routed."Origin" = i_origin.label
JOIN i_dest ON routed."Dest" = i_dest.label
JOIN i_route ON routed."Route" = i_route.label"""
)
ORACLE["indexed_features"] = ORACLE["feature_vectors"]


# Models.


def train_score(spark, sf_dir):
    """All flights by their true class, and whether the model, saved and loaded again,
    is right at least as often as the largest class is."""
    rows = model.delay_bucket(features(spark, sf_dir))
    scored = materialise(model.score(rows, trained(spark, sf_dir)), "scored")
    true = F.col("ArrDelayBucket")
    classes = scored.groupBy(true.alias("label")).agg(
        F.count("*").alias("flights"), F.sum((F.col("Prediction") == true).cast("int")).alias("right")
    )
    better = classes.agg(F.sum("right") >= F.max("flights")).first()[0]
    return classes.select("label", "flights", F.lit(better).alias("better"))


QUERIES["train_score"] = train_score
ORACLE["train_score"] = f"""WITH {sql.FEATURES}
SELECT {sql.bucket('"ArrDelay"')} AS label, count(*) AS flights, true AS better FROM features GROUP BY 1"""


def batch_score(spark, sf_dir):
    """Requests with their distances, scored in one pass; is each prediction a class?"""
    asked = dist.with_distance(
        full_requests(spark, sf_dir).drop("ts"),
        stored_distances(spark, sf_dir),
    )
    scored = model.score(asked, trained(spark, sf_dir), keep_route=True)
    return scored.select("UUID", "Carrier", "Route", "Distance", "DepDelay", F.col("Prediction").isin(0.0, 1.0, 2.0, 3.0).alias("valid"))


QUERIES["batch_score"] = batch_score
ORACLE["batch_score"] = f"""WITH {sql.ENRICHED}
SELECT "UUID", "Carrier", "Route", "Distance", "DepDelay", true AS valid FROM enriched"""


def minutes_score(spark, sf_dir):
    """Requests with a delay in minutes; does it lie among the delays learnt from?"""
    learnt = stored_features(spark, sf_dir)
    low, high = learnt.agg(F.min("ArrDelay"), F.max("ArrDelay")).first()
    fitted = model.train_regressor(learnt)
    asked = dist.with_distance(
        full_requests(spark, sf_dir).drop("ts"),
        stored_distances(spark, sf_dir),
    )
    scored = model.score_minutes(asked, fitted)
    return scored.select(
        "UUID", "Origin", "Dest", "FlightNum", "Distance", F.col("Delay").between(low, high).alias("valid")
    )


QUERIES["minutes_score"] = minutes_score
ORACLE["minutes_score"] = f"""WITH {sql.ENRICHED}
SELECT "UUID", "Origin", "Dest", "FlightNum", "Distance", true AS valid FROM enriched"""


def foreign_features(spark, sf_dir):
    """Features as another writer prints them, with offsets, read again."""
    path = work_path(spark, "features")
    own = feat.alike_together(features(spark, sf_dir))
    shown = {c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS") for c in ("CRSDepTime", "CRSArrTime")}
    offset = F.when(F.col("DayOfMonth") % 2 == 0, "-08:00").otherwise("Z")
    printed = own.withColumns({c: F.concat(t, offset) for c, t in shown.items()})
    printed = printed.withColumn("FlightDate", F.concat(F.col("FlightDate").cast("string"), F.lit("T00:00:00.000"), offset))
    files.write_json(printed, path, compression="bzip2")
    return times_as_text(tables.read_features(spark, path))


QUERIES["foreign_features"] = foreign_features
ORACLE["foreign_features"] = ORACLE["feature_extraction"]


def accuracy(spark, sf_dir):
    """How often the class of the departure delay is that of the arrival delay."""
    rows = model.delay_bucket(feat.drop_unknown_delays(flights(spark, sf_dir)))
    guess = model.Bucketizer(
        splits=model.DELAY_SPLITS, inputCol="DepDelay", outputCol="Prediction"
    )
    return model.accuracy_table(guess.transform(rows))


QUERIES["accuracy"] = accuracy
ORACLE["accuracy"] = f"""WITH {sql.FEATURES}
SELECT avg(CASE WHEN {sql.bucket('"DepDelay"')} = {sql.bucket('"ArrDelay"')} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS accuracy
FROM features"""
