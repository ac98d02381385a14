"""The jobs, each a function of a session and paths."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag import schemas
from skylag.functions.labels import delay_label
from skylag.functions.messages import from_message, split_malformed
from skylag.operators import distances as dist
from skylag.operators import features as feat
from skylag.operators import lookups, model, requests
from skylag.session import materialise
from skylag.sinks import files, folders
from skylag.sources import tables, topics
from skylag.streaming import delivery, matching, scoring, sinks, waiting


def run_extract(
    spark: SparkSession, flights_path: str, out: str, fraction: float | None = None,
    seed: int = 27, n_files: int | None = None, fmt: str = "json",
) -> None:
    """Flights to sorted training features, as bzip2 JSON lines or as Parquet.

    Copies of a flight are told apart by their place in the flights table, so
    that many of them do not share one sort range.
    """
    flights = tables.with_row_key(tables.read_flights(spark, flights_path))
    rows = feat.extract_features(flights, fraction, seed, keep=["RowKey"])
    ordered = feat.sort_features(rows, tie="RowKey")
    if fmt == "json":
        files.write_json(ordered, out, n_files, compression="bzip2")
    else:
        ordered.write.mode("overwrite").format(fmt).save(out)


@dataclass
class Training:
    """What a training run reports."""

    nulls: dict[str, int]
    accuracy: float
    predicted: dict[float, int]
    sample: DataFrame


def run_train(
    spark: SparkSession, features_path: str, model_path: str, bucketizer_path: str,
    max_bins: int = model.MAX_BINS, holdout: float | None = None, seed: int = 42,
    fmt: str = "json", **forest: int,
) -> Training:
    """Fit, save and evaluate the classifier.

    Text features are decoded once and kept as a table, because fitting reads
    them many times; a columnar table is read where it is. Accuracy is taken on the training rows unless ``holdout``
    sets a share apart.
    """
    if fmt == "json":
        stored = materialise(tables.read_features(spark, features_path), "features")
    else:
        stored = spark.read.schema(schemas.FEATURES).format(fmt).load(features_path)
    nulls = {r["column_name"]: r["null_count"] for r in feat.null_profile(stored).collect()}
    if holdout:
        fit_on, test_on = stored.randomSplit([1 - holdout, holdout], seed)
    else:
        fit_on = test_on = stored
    fitted = model.train(fit_on, max_bins=max_bins, seed=seed, **forest)
    model.save_model(fitted, model_path)
    model.save_bucketizer(bucketizer_path)
    ready = model.for_serving(fitted) if holdout else fitted
    scored = materialise(model.score(model.delay_bucket(test_on), ready), "scored")
    counts = model_counts(scored)
    preview = feat.preview(scored.sample(False, 0.001, 18), ["CRSDepTime"], 6)
    return Training(nulls, model.accuracy(scored), counts, preview)


def run_train_minutes(
    spark: SparkSession, features_path: str, model_path: str, fmt: str = "json", seed: int = 42,
) -> None:
    """Fit and save the model that predicts the delay in minutes."""
    if fmt == "json":
        stored = materialise(tables.read_features(spark, features_path), "features")
    else:
        stored = spark.read.schema(schemas.FEATURES).format(fmt).load(features_path)
    model.save_model(model.train_regressor(stored, seed=seed), model_path)


def run_minutes(
    spark: SparkSession, requests_path: str, model_path: str, out: str, day: str,
    rejects: str | None = None,
) -> int:
    """One day of requests with their delay in minutes into that day's folder of results.
    Requests count weekdays from 0, the model from 1. Rejects as in daily scoring."""
    asked = tables.read_requests(spark, requests_path, day)
    scored = model.score_minutes(asked, model.load_model(model_path), align_dow=True)
    files.write_daily(scored, out, day)
    return _keep_rejects(tables.read_request_rejects(spark, requests_path, day), rejects, day)


def model_counts(scored: DataFrame) -> dict[float, int]:
    """Rows for each predicted class: four at most."""
    counted = scored.groupBy("Prediction").count()
    return {r["Prediction"]: r["count"] for r in counted.collect()}


def run_distances(
    spark: SparkSession, flights_path: str, out: str, n_files: int | None = None
) -> None:
    """Flights to the distance table, as JSON lines by distance."""
    flights = tables.read_flights(spark, flights_path)
    files.write_json(dist.by_distance(dist.route_distances(flights)), out, n_files)


def run_migrate(spark: SparkSession, source: str, target: str, fmt: str = "json") -> None:
    """Put the distances of ``source`` into the keyed table ``target``.

    The table lies in folders by a hash of the route; those that no change touches stay
    as they are. New files are written beside the current ones before they take their
    place, so a stream that reads the current ones goes on. A table kept in whole
    versions is taken over at the first write.
    """
    reader = spark.read.schema(schemas.DISTANCES).format(fmt)
    changes = dist.select_distances(reader.load(source))
    if not folders.commits(spark, target):
        current = tables.current_version(spark, target)
        if current:
            stored = spark.read.schema(schemas.DISTANCES).parquet(current)
            changes = dist.upsert(stored, changes, dist.ROUTE)
    folders.upsert_table(changes, target, schemas.DISTANCES, dist.ROUTE)


def run_clean(spark: SparkSession, target: str, keep: int = 2) -> None:
    """Remove files of a table in folders that none of its last ``keep`` states names.
    Readers that began before these states must have ended."""
    folders.clean(spark, target, keep)


def run_fetch(
    spark: SparkSession, tasks: str, out: str, day: str, fmt: str = "parquet", **options: str
) -> None:
    """One day of requests from the task collection to that day's folder."""
    wanted = lookups.day_range("Timestamp", day)
    rows = tables.read_collection(spark, tasks, fmt, wanted, **options)
    files.write_daily(rows, out, day)


def _keep_rejects(bad: DataFrame, path: str | None, day: str) -> int:
    """Store what did not decode, as text, in the day's folder; how many there are."""
    bad = materialise(bad, "rejects")
    if path:
        bad.select("value").write.mode("overwrite").text(files.day_path(path, day))
    return bad.count()


def run_daily_scoring(
    spark: SparkSession, requests_path: str, model_path: str, out: str, day: str,
    rejects: str | None = None,
) -> int:
    """Score one day of requests into that day's folder of results.

    Lines that do not decode go to the day's folder of ``rejects``; their number is
    returned. A day that was never fetched stops the job and replaces nothing.
    """
    asked = tables.read_requests(spark, requests_path, day)
    ready = model.for_serving(model.load_model(model_path))
    files.write_daily(model.score(asked, ready, keep_route=True), out, day)
    return _keep_rejects(tables.read_request_rejects(spark, requests_path, day), rejects, day)


def run_load(
    spark: SparkSession, results_path: str, collection: str, day: str,
    fmt: str = "parquet", rejects: str | None = None, **options: str,
) -> int:
    """One day of results to the result collection. Times stay text, as sent.

    A collection of files has a folder for each day, which a day that is loaded again
    replaces; other stores are appended to. Lines that do not decode go to the day's
    folder of ``rejects``; returns how many.
    """
    day_folder = files.day_path(results_path, day)
    good, bad = tables.split_json_lines(spark, day_folder, schemas.BATCH_RESULT)
    if fmt in ("parquet", "json", "orc"):
        good.drop("request_date").write.mode("overwrite").format(fmt).options(**options).save(files.day_path(collection, day))
    else:
        files.append_collection(good, collection, fmt, **options)
    return _keep_rejects(bad, rejects, day)


def run_stream_scoring(
    spark: SparkSession, request_topic: str, distances_path: str, model_path: str,
    response_topic: str, collection: str, archive: str, checkpoints: str,
    fmt: str = "parquet", collection_fmt: str = "parquet", servers: str = "localhost:9092",
    trigger: str | None = None, console: bool = False, rejects: str | None = None,
    distances_fmt: str = "parquet", distances_options: dict[str, str] | None = None,
    collection_options: dict[str, str] | None = None, topic_options: dict[str, str] | None = None,
    independent: bool = False,
):
    """Start the continuous job with its sinks; ``sinks.run`` waits for it.

    The topic is read and scored once for all sinks, each of which gets a micro-batch
    once, and the distances are those that are current when the batch begins. With
    ``independent`` each sink is a query of its own that reads and scores for itself,
    with the distances of the start, so a slow sink does not hold up the others.

    Messages that do not decode go to ``rejects``. ``topic_options`` may limit the
    rate of a broker (``maxOffsetsPerTrigger``, ``minPartitions``). ``console`` prints
    some rows of each micro-batch as well.
    """
    messages = topics.stream_topic(spark, request_topic, fmt, servers, **(topic_options or {}))
    fitted = model.load_model(model_path)

    def known(version: str | None) -> DataFrame:
        return tables.read_distances(spark, distances_path, distances_fmt, version, **(distances_options or {}))

    if not independent:
        writers = {
            "collection": delivery.collection_writer(collection, collection_fmt, **(collection_options or {})),
            "topic": delivery.topic_writer(response_topic, fmt, servers),
            "files": delivery.collection_writer(archive),
        }
        if console:
            writers["console"] = delivery.console_writer()
        raw = {}
        if rejects:
            keep = delivery.collection_writer(rejects)
            raw["rejects"] = lambda batch, n: keep(split_malformed(batch)[1], n)
        return {
            "scored": delivery.deliver(
                messages, lambda batch, version: scoring.score_stream(batch, known(version), fitted), writers,
                f"{checkpoints}/scored", f"{checkpoints}/ledger",
                lambda: tables.distances_version(spark, distances_path, distances_fmt), raw, trigger,
            )
        }
    scored = scoring.score_stream(messages, known(None), fitted)
    targets = {
        "collection": lambda d: sinks.sink_collection(
            d, collection, f"{checkpoints}/collection", collection_fmt, trigger, **(collection_options or {})
        ),
        "topic": lambda d: sinks.sink_topic(
            d, response_topic, f"{checkpoints}/topic", fmt, servers, trigger
        ),
        "files": lambda d: sinks.sink_parquet(d, archive, f"{checkpoints}/files", trigger),
    }
    if console:
        targets["console"] = lambda d: sinks.sink_console(d, trigger)
    started = sinks.start_sinks(scored, targets)
    if rejects:
        _, bad = split_malformed(messages)
        started["rejects"] = sinks.sink_parquet(bad, rejects, f"{checkpoints}/rejects", trigger)
    return started


def run_match(
    spark: SparkSession, request_topic: str, response_topic: str, out: str, checkpoint: str,
    fmt: str = "parquet", servers: str = "localhost:9092", wait: str = "20 seconds",
    trigger: str | None = None, timers: bool = False,
):
    """Start the job that pairs requests with their responses, by the topics' own times.
    With ``timers`` an answer goes out as soon as none before it can come, without
    them a join gives all rows after the end of the wait, at most one wait later."""
    sides = []
    for topic, schema in ((request_topic, schemas.STREAM_REQUEST), (response_topic, schemas.SCORED)):
        rows = topics.stream_topic(spark, topic, fmt, servers).select(
            from_message("value", schema).alias("m"), F.col("timestamp").alias("ts")
        )
        sides.append(rows.where(F.col("m.UUID").isNotNull()).select("m.*", "ts"))
    match = waiting.wait_stream if timers else matching.match_stream
    matched = match(*sides, wait=wait)
    return sinks.sink_parquet(matched, out, checkpoint, trigger)


def run_prepare(
    spark: SparkSession, forms: DataFrame, distances_path: str,
    topic: str | None = None, tasks: str | None = None, fmt: str = "parquet",
    servers: str = "localhost:9092", on_missing: str = "error", tasks_fmt: str = "parquet",
    rejects: str | None = None,
) -> DataFrame:
    """Form values to complete requests, sent to a topic or kept as daily tasks.

    The requests are written before they are sent, so that a request keeps its
    id even if a task is repeated. With ``rejects`` forms of routes without distance
    are appended there and the others go on, whatever ``on_missing`` says.
    """
    known = tables.read_distances(spark, distances_path)
    if rejects:
        files.append_collection(requests.without_distance(forms, known), rejects)
        on_missing = "drop"
    made = materialise(requests.prepare_requests(forms, known, on_missing), "requests")
    if topic:
        files.emit_requests(made, topic, fmt, servers)
    if tasks:
        files.append_collection(made.drop("UUID"), tasks, tasks_fmt)
    return made


def results_page(results: DataFrame, day: str) -> DataFrame:
    """One day of scored requests with the wording of the batch page."""
    rows = lookups.on_day(results, day)
    shown = ["Timestamp", "Carrier", "FlightDate", "Origin", "Dest", "Distance", "DepDelay"]
    return rows.select(
        *shown, delay_label(F.col("Prediction"), "batch").alias("PredictedDelay")
    )
