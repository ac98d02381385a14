"""Registered queries: streams, run until their input is used up."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from skylag.checks import sql
from skylag.checks.common import flights, stored_distances, times_as_text, trained
from skylag.checks.lookups import ORACLE as _LOOKUP_ORACLE
from skylag.checks.messages import MATCH, ORACLE as _BATCH_ORACLE
from skylag.checks.messages import WELL_FORMED, request_messages
from skylag.functions.messages import decode_text, split_malformed
from skylag.operators import distances as dist
from skylag.operators import summaries
from skylag.schemas import DISTANCES, SCORED
from skylag.session import state_partitions, tune, work_path
from skylag.sinks import files, folders
from skylag.sources import tables, testbed, topics
from skylag.streaming import delivery, matching, scoring, sinks, waiting
from skylag.streaming import summaries as keeping

QUERIES = {}
ORACLE = {}

NOW = "available"
# Columns of an enriched request, as a sink stores them.
STORED = ["UUID", "Carrier", "Origin", "Dest", "DepDelay", "Distance", "DayOfWeek", "Timestamp"]
_STORED_SQL = """"UUID", "Carrier", "Origin", "Dest", "DepDelay", "Distance", "DayOfWeek",
  replace("Timestamp", 'T', ' ') AS "Timestamp\""""


def _topic(spark, rows=None, sf_dir=None):
    path = work_path(spark, "topic")
    files.write_topic(request_messages(spark, sf_dir) if rows is None else rows, path)
    return path


def _enriched_stream(spark, sf_dir, topic):
    stream = topics.stream_topic(spark, topic)
    return scoring.enrich_requests(stream, stored_distances(spark, sf_dir)).select(*STORED)


def _run_to(spark, start, name):
    """Start one sink on a fresh folder, wait until the input is used up."""
    out = work_path(spark, name)
    sinks.drain(start(out, work_path(spark, f"{name}-checkpoint")))
    return out


def _scored_stream(spark, sf_dir, known, model):
    stream = topics.stream_topic(spark, _topic(spark, sf_dir=sf_dir))
    scored = scoring.score_stream(stream, known, model)
    out = _run_to(spark, lambda p, c: sinks.sink_parquet(scored, p, c, NOW), "scored")
    return spark.read.schema(SCORED).parquet(out)


def stream_score(spark, sf_dir):
    """The continuous job: topic to scored rows in files; is each prediction a class?"""
    valid = F.col("Prediction").isin(0.0, 1.0, 2.0, 3.0).alias("valid")
    scored = _scored_stream(spark, sf_dir, stored_distances(spark, sf_dir), trained(tune(spark), sf_dir))
    return times_as_text(scored.select(*STORED, valid))


QUERIES["stream_score"] = stream_score
ORACLE["stream_score"] = f"""WITH {sql.ENRICHED}
SELECT {_STORED_SQL}, true AS valid FROM enriched WHERE {WELL_FORMED}"""


def score_parity(spark, sf_dir):
    """Does a request get the same prediction in the stream and in a batch?"""
    known, model = stored_distances(spark, sf_dir), trained(tune(spark), sf_dir)
    batch = scoring.score_stream(request_messages(spark, sf_dir), known, model)
    batch = batch.select("UUID", F.col("Prediction").alias("other"))
    met = _scored_stream(spark, sf_dir, known, model).join(batch, "UUID", "full")
    return met.select("UUID", F.col("Prediction").eqNullSafe(F.col("other")).alias("same"))


QUERIES["score_parity"] = score_parity
ORACLE["score_parity"] = f"""WITH {sql.REQUESTS} SELECT "UUID", true AS same FROM requests WHERE {WELL_FORMED}"""


def stream_rejects(spark, sf_dir):
    """Messages of the continuous job that do not decode, kept apart."""
    _, bad = split_malformed(topics.stream_topic(spark, _topic(spark, sf_dir=sf_dir)))
    out = _run_to(spark, lambda p, c: sinks.sink_parquet(bad, p, c, NOW), "rejects")
    kept = spark.read.schema("value string").parquet(out)
    return kept.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


QUERIES["stream_rejects"] = stream_rejects
ORACLE["stream_rejects"] = _BATCH_ORACLE["malformed_messages"]


def stream_to_table(spark, sf_dir):
    rows = _enriched_stream(spark, sf_dir, _topic(spark, sf_dir=sf_dir))
    out = _run_to(spark, lambda p, c: sinks.sink_collection(rows, p, c, trigger=NOW), "table")
    return times_as_text(tables.read_collection(spark, out))


QUERIES["stream_to_table"] = stream_to_table
ORACLE["stream_to_table"] = f"""WITH {sql.ENRICHED}
SELECT {_STORED_SQL} FROM enriched WHERE {WELL_FORMED}"""


def stream_to_topic(spark, sf_dir):
    """Enriched requests to a topic; its messages decoded beside their keys."""
    rows = _enriched_stream(spark, sf_dir, _topic(spark, sf_dir=sf_dir))
    schema = rows.schema
    out = _run_to(spark, lambda p, c: sinks.sink_topic(rows, p, c, trigger=NOW), "response")
    sent = topics.read_topic(spark, out)
    keyed = sent.where(F.col("key") == F.get_json_object("value", "$.UUID"))
    return times_as_text(decode_text(keyed, schema))


QUERIES["stream_to_topic"] = stream_to_topic
ORACLE["stream_to_topic"] = ORACLE["stream_to_table"]


def stream_to_parquet(spark, sf_dir):
    rows = _enriched_stream(spark, sf_dir, _topic(spark, sf_dir=sf_dir))
    out = _run_to(spark, lambda p, c: sinks.sink_parquet(rows, p, c, NOW), "files")
    return times_as_text(spark.read.parquet(out))


QUERIES["stream_to_parquet"] = stream_to_parquet
ORACLE["stream_to_parquet"] = ORACLE["stream_to_table"]


def archive_topic(spark, sf_dir):
    topic = _topic(spark, sf_dir=sf_dir)
    out = _run_to(
        spark, lambda p, c: sinks.archive_topic(spark, topic, p, c, trigger=NOW), "archive"
    )
    return sinks.read_archive(spark, out)


QUERIES["archive_topic"] = archive_topic
ORACLE["archive_topic"] = _BATCH_ORACLE["topic_replay"]


def stream_fanout(spark, sf_dir):
    """One enriched stream into a collection, a topic and files."""
    rows = _enriched_stream(spark, sf_dir, _topic(spark, sf_dir=sf_dir))
    at = {name: work_path(spark, name) for name in ("table", "topic", "files")}
    marks = {name: work_path(spark, f"{name}-checkpoint") for name in at}
    started = sinks.start_sinks(
        rows,
        {
            "table": lambda d: sinks.sink_collection(d, at["table"], marks["table"], trigger=NOW),
            "topic": lambda d: sinks.sink_topic(d, at["topic"], marks["topic"], trigger=NOW),
            "files": lambda d: sinks.sink_parquet(d, at["files"], marks["files"], NOW),
        },
    )
    sinks.drain(*started.values())
    stored = {
        "table": tables.read_collection(spark, at["table"]),
        "topic": decode_text(topics.read_topic(spark, at["topic"]), rows.schema),
        "files": spark.read.parquet(at["files"]),
    }
    seen = [
        df.select(F.lit(name).alias("sink"), "UUID", "Distance") for name, df in stored.items()
    ]
    return seen[0].unionByName(seen[1]).unionByName(seen[2])


QUERIES["stream_fanout"] = stream_fanout
ORACLE["stream_fanout"] = f"""WITH {sql.ENRICHED}
SELECT sink, "UUID", "Distance" FROM enriched, (VALUES ('table'), ('topic'), ('files')) AS s(sink)
WHERE {WELL_FORMED}"""


def stream_fanout_once(spark, sf_dir):
    """The same with each micro-batch computed once for two writers."""
    rows = _enriched_stream(spark, sf_dir, _topic(spark, sf_dir=sf_dir))
    left, right = work_path(spark, "left"), work_path(spark, "right")

    def writer(path):
        return lambda batch, n: batch.write.mode("overwrite").parquet(
            sinks.batch_folder(path, batch, n)
        )

    query = sinks.fan_out(
        rows, {"left": writer(left), "right": writer(right)},
        work_path(spark, "fan-checkpoint"), NOW,
    )
    sinks.drain(query)
    seen = [
        spark.read.parquet(path).select(F.lit(name).alias("sink"), "UUID", "Distance")
        for name, path in (("left", left), ("right", right))
    ]
    return seen[0].unionByName(seen[1])


QUERIES["stream_fanout_once"] = stream_fanout_once
ORACLE["stream_fanout_once"] = f"""WITH {sql.ENRICHED}
SELECT sink, "UUID", "Distance" FROM enriched, (VALUES ('left'), ('right')) AS s(sink)
WHERE {WELL_FORMED}"""


def stream_restart(spark, sf_dir):
    """Half of the messages, stop, the other half, then a run with nothing new."""
    sent = request_messages(spark, sf_dir)
    early = F.dayofmonth("timestamp") <= 15
    topic = _topic(spark, sent.where(early))
    rows = _enriched_stream(spark, sf_dir, topic)
    out, mark = work_path(spark, "files"), work_path(spark, "files-checkpoint")
    sinks.drain(sinks.sink_parquet(rows, out, mark, NOW))
    files.write_topic(sent.where(~early), topic)
    for _ in range(2):
        sinks.drain(sinks.sink_parquet(rows, out, mark, NOW))
    return times_as_text(spark.read.parquet(out))


QUERIES["stream_restart"] = stream_restart
ORACLE["stream_restart"] = ORACLE["stream_to_table"]


def stream_foreach_batch(spark, sf_dir):
    """Scoring by micro-batch callback; the features beside each prediction."""
    stream = topics.stream_topic(spark, _topic(spark, sf_dir=sf_dir))
    known = stored_distances(spark, sf_dir)
    out = work_path(spark, "responses")
    apply = scoring.score_batch(lambda: known, trained(tune(spark), sf_dir), out)
    sinks.drain(sinks.each_batch(stream, apply, work_path(spark, "batch-checkpoint"), NOW))
    scored = spark.read.parquet(out).where(F.col("Prediction").between(0, 3))
    return times_as_text(scored.select(*STORED))


QUERIES["stream_foreach_batch"] = stream_foreach_batch
ORACLE["stream_foreach_batch"] = ORACLE["stream_to_table"]


def _fed(spark, sides, order, closing, start):
    """Run a query over streams whose rows arrive part by part in the given order.

    ``sides`` are tables with UUID and ts, ``closing`` the last row of each. After each
    part of both sides the query runs until the input is used up and stops; the next
    run goes on from its checkpoint.
    """
    paths = [work_path(spark, "side") for _ in sides]
    part = F.pmod(F.xxhash64("UUID", "ts"), F.lit(len(order)))
    for step in order:
        for path, rows, last in zip(paths, sides, closing, strict=True):
            rows.where(part == step).write.mode("append").parquet(path)
            if step == order[-1]:
                last.write.mode("append").parquet(path)
        start([spark.readStream.schema(rows.schema).parquet(path) for path, rows in zip(paths, sides, strict=True)])


def _stream_match(match, order):
    def query(spark, sf_dir):
        late = "9999"
        asked = testbed.requests(tune(spark), sf_dir).select("UUID", F.col("ts").cast("timestamp"))
        answers = testbed.mixed_responses(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
        # Parts come in an order of their own: no row is late within the whole span.
        # Then a row on each side, far later, moves the watermark past all others.
        first, end = F.min("ts").cast("long"), F.max("ts")
        span, end = asked.agg((end.cast("long") - first).alias("s"), F.unix_micros(end).alias("end")).first()
        after = F.timestamp_micros(F.lit(end + (3 * span + 86_400) * 1_000_000))
        last = spark.range(1).select(F.lit(late).alias("UUID"), after.alias("ts"))
        out, mark = work_path(spark, "matched"), work_path(spark, "matched-checkpoint")

        def start(streams):
            matched = match(*streams, wait="20 seconds", lateness=f"{span + 120} seconds")
            with state_partitions(spark):
                sinks.drain(sinks.sink_parquet(matched.select("UUID", "status", "Prediction"), out, mark, NOW))

        _fed(spark, [asked, answers], order, [last, last.withColumn("Prediction", F.lit(0.0))], start)
        rows = spark.read.schema("UUID string, status string, Prediction double").parquet(out)
        return rows.where(F.col("UUID") != late)

    return query


# The same rows in two orders of arrival, by a join and by timers.
QUERIES["stream_match"] = _stream_match(matching.match_stream, (0, 1, 2))
QUERIES["stream_match_reversed"] = _stream_match(matching.match_stream, (2, 1, 0))
QUERIES["stream_match_timers"] = _stream_match(waiting.wait_stream, (0, 1, 2))
QUERIES["stream_match_timers_reversed"] = _stream_match(waiting.wait_stream, (2, 1, 0))
for _name in ("stream_match", "stream_match_reversed", "stream_match_timers", "stream_match_timers_reversed"):
    ORACLE[_name] = MATCH


def stream_renewed_lookup(spark, sf_dir):
    """Requests scored before and after the distance table is migrated: those of the
    second half of a month see the distances of all flights, the others of half a year."""
    sent = request_messages(spark, sf_dir)
    early = F.dayofmonth("timestamp") <= 15
    known, topic, out = work_path(spark, "distances"), _topic(spark, sent.where(early)), work_path(spark, "scored")
    ledger, mark = work_path(spark, "ledger"), work_path(spark, "checkpoint")
    all_flights = flights(spark, sf_dir)

    def put(rows):
        folders.upsert_table(dist.route_distances(rows), known, DISTANCES, dist.ROUTE, buckets=8)

    def score(batch, version):
        return scoring.enrich_requests(batch, tables.read_distances(spark, known, version=version)).select(*STORED)

    def run():
        query = delivery.deliver(
            topics.stream_topic(spark, topic), score, {"out": delivery.collection_writer(out)}, mark, ledger,
            lambda: tables.distances_version(spark, known), trigger=NOW,
        )
        sinks.drain(query)

    put(all_flights.where("Month <= 6"))
    run()
    put(all_flights)
    files.write_topic(sent.where(~early), topic)
    run()
    return times_as_text(spark.read.parquet(out).select(*STORED))


QUERIES["stream_renewed_lookup"] = stream_renewed_lookup
ORACLE["stream_renewed_lookup"] = f"""WITH {sql.ENRICHED},
half AS (SELECT "Origin", "Dest", avg("Distance") AS d FROM flights WHERE "Month" <= 6 GROUP BY 1, 2)
SELECT e."UUID", e."Carrier", e."Origin", e."Dest", e."DepDelay",
  CASE WHEN e."DayOfMonth" <= 15 THEN coalesce(half.d, 0.0) ELSE e."Distance" END AS "Distance",
  e."DayOfWeek", replace(e."Timestamp", 'T', ' ') AS "Timestamp"
FROM enriched e LEFT JOIN half ON half."Origin" = e."Origin" AND half."Dest" = e."Dest" WHERE {WELL_FORMED}"""


def stream_fanout_recovered(spark, sf_dir):
    """One enriched stream for three sinks; the job dies once in the topic's write and
    once after it, and each sink, the topic read without doubles, has each row once."""
    topic, known = _topic(spark, sf_dir=sf_dir), stored_distances(spark, sf_dir)
    at = {name: work_path(spark, name) for name in ("table", "topic", "files")}
    ledger, mark = work_path(spark, "ledger"), work_path(spark, "checkpoint")
    to_topic = delivery.topic_writer(at["topic"])

    def dying(when):
        def write(batch, batch_id):
            if when == "before":
                raise RuntimeError("the job dies")
            to_topic(batch, batch_id)
            if when == "after":
                raise RuntimeError("the job dies")

        return write

    schema = scoring.enrich_requests(topics.stream_topic(spark, topic), known).select(*STORED).schema
    for when in ("before", "after", "never"):
        writers = {"table": delivery.collection_writer(at["table"]), "topic": dying(when), "files": delivery.collection_writer(at["files"])}
        query = delivery.deliver(
            topics.stream_topic(spark, topic), lambda batch, _: scoring.enrich_requests(batch, known).select(*STORED),
            writers, mark, ledger, trigger=NOW,
        )
        try:
            sinks.drain(query)
        except StreamingQueryException:
            if when == "never":
                raise
    stored = {
        "table": spark.read.parquet(at["table"]),
        "topic": decode_text(delivery.once(topics.read_topic(spark, at["topic"])), schema),
        "files": spark.read.parquet(at["files"]),
    }
    seen = [df.select(F.lit(name).alias("sink"), "UUID", "Distance") for name, df in stored.items()]
    return seen[0].unionByName(seen[1]).unionByName(seen[2])


QUERIES["stream_fanout_recovered"] = stream_fanout_recovered
ORACLE["stream_fanout_recovered"] = ORACLE["stream_fanout"]


def _kept_summary(rows_of, summarise, keys):
    """A summary kept from a stream of rows in two parts, with a restart between them."""

    def query(spark, sf_dir):
        rows = rows_of(spark, sf_dir)
        source, path, mark = (work_path(spark, name) for name in ("rows", "summary", "checkpoint"))
        half = F.pmod(F.xxhash64("TailNum"), F.lit(2)) == 0
        for part in (half, ~half):
            rows.where(part).write.mode("append").parquet(source)
            stream = spark.readStream.schema(rows.schema).parquet(source)
            with state_partitions(spark):
                sinks.drain(keeping.keep_summary(stream, summarise, keys, path, mark, buckets=8, trigger=NOW))
        return folders.read_folders(spark, path, summarise(rows).schema)

    return query


def _planes(spark, sf_dir):
    return testbed.airplanes(tune(spark), sf_dir)


def _fleet_rows(rows):
    return rows.where(F.col("TailNum").isNotNull()).groupBy("Carrier", "TailNum").agg(F.count("*").alias("flights"))


QUERIES["stream_flights_by_month"] = _kept_summary(flights, summaries.month_counts, ["Year", "Month"])
ORACLE["stream_flights_by_month"] = _LOOKUP_ORACLE["flights_by_month"]
QUERIES["stream_flights_per_airplane"] = _kept_summary(flights, summaries.flights_per_airplane, ["TailNum", *summaries.FLIGHT_ENTRY])
ORACLE["stream_flights_per_airplane"] = _LOOKUP_ORACLE["flights_per_airplane"]
QUERIES["stream_fleets"] = _kept_summary(flights, _fleet_rows, ["Carrier", "TailNum"])
ORACLE["stream_fleets"] = f"""WITH {sql.FLIGHTS}
SELECT "Carrier", "TailNum", count(*) AS flights FROM flights GROUP BY 1, 2"""
QUERIES["stream_manufacturers"] = _kept_summary(_planes, summaries.manufacturer_totals, ["Manufacturer"])
ORACLE["stream_manufacturers"] = _LOOKUP_ORACLE["manufacturer_totals"]
