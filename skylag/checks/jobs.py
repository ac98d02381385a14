"""Registered queries: whole jobs, and models whose predictions SQL can write.

These models learn from all flights, with a delay that one column decides, so that the
tree's thresholds, and with them each prediction, are known beforehand.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from skylag import schemas
from skylag.checks import sql
from skylag.checks.common import distances, features, flights, full_requests, stored_distances, times_as_text
from skylag.checks.features import ORACLE as _FEATURE_ORACLE
from skylag.checks.lookups import ORACLE as _LOOKUP_ORACLE
from skylag.checks.messages import _ON_DAY, DAY, WELL_FORMED, _tasks, request_messages
from skylag.functions.messages import decode_text
from skylag.operators import distances as dist
from skylag.operators import model
from skylag.plans import jobs
from skylag.session import materialise, work_path
from skylag.sinks import files
from skylag.sources import tables, topics
from skylag.streaming import delivery, sinks

QUERIES = {}
ORACLE = {}

# One tree over all rows and columns.
ONE_TREE = {"numTrees": 1, "featureSubsetStrategy": "all", "bootstrap": False}
# Departure delays of flights are whole minutes from -9 to 40, and the classes part them
# at 0 and 30; a tree parts two neighbours half way.
_CLASS = 'CASE WHEN {c} <= -0.5 THEN 1.0 WHEN {c} <= 29.5 THEN 2.0 ELSE 3.0 END'


def _predicted(column):
    return f"CAST({_CLASS.format(c=column)} AS DOUBLE)"


def _stored_flights(spark, sf_dir):
    path = work_path(spark, "flights")
    flights(spark, sf_dir).write.parquet(path)
    return path


def job_extract(spark, sf_dir):
    out = work_path(spark, "features")
    jobs.run_extract(spark, _stored_flights(spark, sf_dir), out)
    return times_as_text(tables.read_features(spark, out))


QUERIES["job_extract"] = job_extract
ORACLE["job_extract"] = _FEATURE_ORACLE["feature_extraction"]


def job_distances(spark, sf_dir):
    out = work_path(spark, "distances")
    jobs.run_distances(spark, _stored_flights(spark, sf_dir), out)
    return tables.read_distances(spark, out, "json")


QUERIES["job_distances"] = job_distances
ORACLE["job_distances"] = _LOOKUP_ORACLE["route_distances"]


def job_migrate(spark, sf_dir):
    """Distances of half a year, then those of all flights put in, into a table in folders."""
    target, half, whole = work_path(spark, "table"), work_path(spark, "half"), work_path(spark, "whole")
    rows = flights(spark, sf_dir).where("Month <= 6").withColumn("Distance", F.col("Distance") + 1)
    files.write_json(dist.route_distances(rows), half)
    files.write_json(distances(spark, sf_dir), whole)
    for source in (half, whole):
        jobs.run_migrate(spark, source, target)
    return tables.read_distances(spark, target)


QUERIES["job_migrate"] = job_migrate
ORACLE["job_migrate"] = _LOOKUP_ORACLE["route_distances"]


def _train(spark, sf_dir):
    """The training job on flights that arrive as late as they depart."""
    path, fitted = work_path(spark, "features"), work_path(spark, "model")
    features(spark, sf_dir).withColumn("ArrDelay", F.col("DepDelay")).write.parquet(path)
    report = jobs.run_train(spark, path, fitted, work_path(spark, "classes"), fmt="parquet", maxDepth=3, **ONE_TREE)
    return fitted, report


def job_train(spark, sf_dir):
    """What the training job reports: accuracy and the rows of each predicted class."""
    _, report = _train(spark, sf_dir)
    rows = [("accuracy", report.accuracy), *[(f"class {k:g}", float(n)) for k, n in report.predicted.items()]]
    rows += [(f"nulls {c}", float(n)) for c, n in report.nulls.items()]
    return spark.createDataFrame(rows, "measure string, value double")


QUERIES["job_train"] = job_train
ORACLE["job_train"] = f"""WITH {sql.FEATURES}
SELECT 'accuracy' AS measure, CAST(1 AS DOUBLE) AS value
UNION ALL SELECT 'class ' || CAST(CAST({_predicted('"DepDelay"')} AS INT) AS VARCHAR), CAST(count(*) AS DOUBLE) FROM features GROUP BY 1"""


def model_accuracy(spark, sf_dir):
    """How often that model is right about the true delays of all flights."""
    fitted, _ = _train(spark, sf_dir)
    rows = model.delay_bucket(features(spark, sf_dir))
    scored = materialise(model.score(rows, model.for_serving(model.load_model(fitted))), "scored")
    return spark.createDataFrame([(round(model.accuracy(scored), 9),)], "accuracy double")


QUERIES["model_accuracy"] = model_accuracy
ORACLE["model_accuracy"] = f"""WITH {sql.FEATURES}
SELECT round(avg(CASE WHEN {_predicted('"DepDelay"')} = {sql.bucket('"ArrDelay"')} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 9) AS accuracy
FROM features"""


def model_predictions(spark, sf_dir):
    """Requests with the class that model predicts."""
    fitted, _ = _train(spark, sf_dir)
    asked = dist.with_distance(full_requests(spark, sf_dir).drop("ts"), stored_distances(spark, sf_dir))
    scored = model.score(asked, model.for_serving(model.load_model(fitted)), keep_route=True)
    return scored.select("UUID", "Carrier", "Route", "Distance", "DepDelay", "Prediction")


QUERIES["model_predictions"] = model_predictions
ORACLE["model_predictions"] = f"""WITH {sql.ENRICHED}
SELECT "UUID", "Carrier", "Route", "Distance", "DepDelay", {_predicted('"DepDelay"')} AS "Prediction" FROM enriched"""


def job_daily_scoring(spark, sf_dir):
    """Fetch a day, score it with that model, load the results twice."""
    fitted, _ = _train(spark, sf_dir)
    daily, results, collection = (work_path(spark, n) for n in ("daily", "results", "collection"))
    jobs.run_fetch(spark, _tasks(spark, sf_dir), daily, DAY)
    jobs.run_daily_scoring(spark, daily, fitted, results, DAY)
    for _ in range(2):
        jobs.run_load(spark, results, collection, DAY)
    stored = tables.read_collection(spark, collection)
    return stored.select("Carrier", "Origin", "Dest", "FlightNum", "Route", "DepDelay", "Distance", "Prediction")


QUERIES["job_daily_scoring"] = job_daily_scoring
ORACLE["job_daily_scoring"] = f"""WITH {sql.ENRICHED}
SELECT "Carrier", "Origin", "Dest", "FlightNum", "Route", "DepDelay", "Distance", {_predicted('"DepDelay"')} AS "Prediction"
FROM enriched WHERE {_ON_DAY}"""


def job_stream_scoring(spark, sf_dir):
    """The continuous job with that model and all its sinks, run until the topic is used up."""
    fitted, _ = _train(spark, sf_dir)
    topic, known = work_path(spark, "topic"), work_path(spark, "distances")
    files.write_topic(request_messages(spark, sf_dir), topic)
    files.write_version(distances(spark, sf_dir), known, dist.ROUTE)
    at = {name: work_path(spark, name) for name in ("topic", "table", "files", "rejects", "marks")}
    started = jobs.run_stream_scoring(
        spark, topic, known, fitted, at["topic"], at["table"], at["files"], at["marks"], trigger="available", rejects=at["rejects"]
    )
    sinks.drain(*started.values())
    stored = {
        "table": spark.read.parquet(at["table"]),
        "topic": decode_text(delivery.once(topics.read_topic(spark, at["topic"])), schemas.SCORED),
        "files": spark.read.parquet(at["files"]),
    }
    seen = [df.select(F.lit(n).alias("sink"), "UUID", "Distance", "Prediction") for n, df in stored.items()]
    bad = spark.read.parquet(at["rejects"]).select(F.lit("rejects").alias("sink"), F.col("value").alias("UUID"))
    return seen[0].unionByName(seen[1]).unionByName(seen[2]).unionByName(bad, allowMissingColumns=True)


QUERIES["job_stream_scoring"] = job_stream_scoring
ORACLE["job_stream_scoring"] = f"""WITH {sql.ENRICHED}
SELECT sink, "UUID", "Distance", {_predicted('"DepDelay"')} AS "Prediction"
FROM enriched, (VALUES ('table'), ('topic'), ('files')) AS s(sink) WHERE {WELL_FORMED}
UNION ALL SELECT 'rejects', 'ready', NULL, NULL FROM enriched WHERE NOT ({WELL_FORMED})"""


def minutes_predictions(spark, sf_dir):
    """Requests with the minutes that a tree predicts which learnt delays of 100 minutes in
    the second half of each month and none in the first."""
    late = F.when(F.col("DayOfMonth") > 15, 100.0).otherwise(0.0)
    learnt = materialise(features(spark, sf_dir).withColumn("ArrDelay", late), "features")
    fitted = model.train_regressor(learnt, maxDepth=1, **ONE_TREE)
    asked = dist.with_distance(full_requests(spark, sf_dir).drop("ts"), stored_distances(spark, sf_dir))
    return model.score_minutes(asked, fitted).select("UUID", "Origin", "Dest", "FlightNum", "Distance", "Delay")


QUERIES["minutes_predictions"] = minutes_predictions
ORACLE["minutes_predictions"] = f"""WITH {sql.ENRICHED}
SELECT "UUID", "Origin", "Dest", "FlightNum", "Distance",
  CAST(CASE WHEN "DayOfMonth" > 15 THEN 100 ELSE 0 END AS DOUBLE) AS "Delay" FROM enriched"""
