"""Registered queries: messages, enrichment, daily folders and collections."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from skylag import schemas
from skylag.checks import sql
from skylag.checks.common import full_requests, stored_distances, times_as_text
from skylag.functions import messages as msg
from skylag.functions.labels import delay_label
from skylag.operators import distances as dist
from skylag.operators import requests
from skylag.plans import jobs
from skylag.session import materialise, tune, work_path
from skylag.sinks import files
from skylag.sources import tables, testbed, topics
from skylag.streaming import scoring

QUERIES = {}
ORACLE = {}

DAY = "2024-01-15"
SENT = [
    "Origin", "FlightNum", "DayOfWeek", "DayOfYear", "DayOfMonth", "Dest", "DepDelay",
    "Timestamp", "FlightDate", "Carrier", "UUID",
]
# Fixed value: the word a job says on its topic when it starts.
READY = "ready"


def request_messages(spark, sf_dir):
    """One JSON message for each event; those of errors are no JSON."""
    e = full_requests(spark, sf_dir, keep=("event_type",))
    broken = F.col("event_type") == "error"
    return e.select(
        F.lit(None).cast("string").alias("key"),
        F.when(broken, F.lit(READY)).otherwise(msg.to_message(*SENT)).alias("value"),
        F.lit("request").alias("topic"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


WELL_FORMED = "event_type <> 'error'"
_JSON = "CAST(to_json({" + ", ".join(f"'{c}': \"{c}\"" for c in SENT) + "}) AS VARCHAR)"
_STAMP = "replace(\"Timestamp\", 'T', ' ') AS \"Timestamp\""
_BASE = ", ".join(
    _STAMP if c == "Timestamp" else f'"{c}"' for c in schemas.REQUEST_COLUMNS
)


def encode_requests(spark, sf_dir):
    return full_requests(spark, sf_dir).select("UUID", msg.to_message(*SENT).alias("value"))


QUERIES["encode_requests"] = encode_requests
ORACLE["encode_requests"] = f'WITH {sql.REQUESTS} SELECT "UUID", {_JSON} AS value FROM requests'


def topic_replay(spark, sf_dir):
    """Send to a topic, read the whole topic again."""
    path = work_path(spark, "topic")
    files.write_topic(request_messages(spark, sf_dir), path)
    return topics.read_topic(spark, path).select("value")


QUERIES["topic_replay"] = topic_replay
ORACLE["topic_replay"] = f"""WITH {sql.REQUESTS}
SELECT CASE WHEN {WELL_FORMED} THEN {_JSON} ELSE '{READY}' END AS value FROM requests"""


def topic_replay_twice(spark, sf_dir):
    """Two replays of a growing topic, each from where the one before ended; the second
    is read twice, for the first time it is not finished."""
    sent = request_messages(spark, sf_dir)
    early = F.dayofmonth("timestamp") <= 15
    path, offsets, seen = work_path(spark, "topic"), work_path(spark, "offsets"), []
    for number, part in enumerate((early, ~early), 1):
        files.write_topic(sent.where(part), path)
        if number == 2:
            topics.read_new(spark, path, offsets)[0].count()
        messages, finish = topics.read_new(spark, path, offsets)
        seen.append(materialise(messages.select("value", F.lit(number).alias("replay")), "replay"))
        finish()
    return seen[0].union(seen[1])


QUERIES["topic_replay_twice"] = topic_replay_twice
ORACLE["topic_replay_twice"] = f"""WITH {sql.REQUESTS}
SELECT CASE WHEN {WELL_FORMED} THEN {_JSON} ELSE '{READY}' END AS value,
  CAST(CASE WHEN "DayOfMonth" <= 15 THEN 1 ELSE 2 END AS INTEGER) AS replay FROM requests"""


def prepared_ids(spark, sf_dir):
    """Forms made requests with random ids and the time of now: are the ids unique, and
    does every time lie between start and end?"""
    forms = testbed.requests(tune(spark), sf_dir).drop("ts", "UUID", "Timestamp")
    known = stored_distances(spark, sf_dir)
    start = dt.datetime.now(dt.UTC).isoformat()[:19]
    made = materialise(requests.prepare_requests(forms, known, "zero"), "prepared")
    end = (dt.datetime.now(dt.UTC) + dt.timedelta(seconds=1)).isoformat()[:19]
    form = F.col("UUID").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
    return made.agg(
        F.count("*").alias("n"), (F.count_distinct("UUID") == F.count("*")).alias("unique_ids"), F.bool_and(form).alias("ids"),
        F.bool_and(F.substring("Timestamp", 1, 19).between(start, end)).alias("in_time"),
    )


QUERIES["prepared_ids"] = prepared_ids
ORACLE["prepared_ids"] = "SELECT count(*) AS n, true AS unique_ids, true AS ids, true AS in_time FROM events"


def parse_requests(spark, sf_dir):
    raw = request_messages(spark, sf_dir).withColumn("value", F.col("value").cast("binary"))
    return times_as_text(msg.parse_requests(raw))


QUERIES["parse_requests"] = parse_requests
ORACLE["parse_requests"] = f"WITH {sql.REQUESTS} SELECT {_BASE} FROM requests WHERE {WELL_FORMED}"


def malformed_messages(spark, sf_dir):
    _, bad = msg.split_malformed(request_messages(spark, sf_dir))
    return bad.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


QUERIES["malformed_messages"] = malformed_messages
ORACLE["malformed_messages"] = f"""WITH {sql.REQUESTS}
SELECT '{READY}' AS value, count(*) AS n FROM requests WHERE NOT ({WELL_FORMED}) HAVING count(*) > 0"""


def enrich_requests(spark, sf_dir):
    return times_as_text(
        scoring.enrich_requests(request_messages(spark, sf_dir), stored_distances(spark, sf_dir))
    )


QUERIES["enrich_requests"] = enrich_requests
ORACLE["enrich_requests"] = f"""WITH {sql.ENRICHED}
SELECT {_BASE}, "Distance", "Route" FROM enriched WHERE {WELL_FORMED}"""


def enrich_requests_strict(spark, sf_dir):
    """Only routes with a distance."""
    asked = full_requests(spark, sf_dir).drop("ts")
    return dist.with_distance(asked, stored_distances(spark, sf_dir), "drop")


QUERIES["enrich_requests_strict"] = enrich_requests_strict
ORACLE["enrich_requests_strict"] = f"""WITH {sql.ENRICHED}
SELECT {sql.cols(SENT)}, "Distance" FROM enriched WHERE found IS NOT NULL"""


def routes_without_distance(spark, sf_dir):
    return dist.routes_without_distance(full_requests(spark, sf_dir), stored_distances(spark, sf_dir))


QUERIES["routes_without_distance"] = routes_without_distance
ORACLE["routes_without_distance"] = f"""WITH {sql.ENRICHED}
SELECT DISTINCT "Origin", "Dest" FROM enriched WHERE found IS NULL"""


def coerce_requests(spark, sf_dir):
    """Form text, some of it no number, to typed fields."""
    form = full_requests(spark, sf_dir).select(
        "UUID", "Carrier", "FlightDate", "Dest", "FlightNum", "Origin",
        F.when(F.col("DayOfMonth") % 5 == 0, F.lit("late"))
        .when(F.col("DayOfMonth") % 5 == 1, F.lit(""))
        .otherwise(F.col("DepDelay").cast("string"))
        .alias("DepDelay"),
    )
    return requests.coerce_request(form)


QUERIES["coerce_requests"] = coerce_requests
ORACLE["coerce_requests"] = f"""WITH {sql.REQUESTS}
SELECT "UUID", "Carrier", "FlightDate", "Dest", "FlightNum", "Origin",
  CASE WHEN "DayOfMonth" % 5 > 1 THEN "DepDelay" END AS "DepDelay" FROM requests"""


def prepare_requests(spark, sf_dir):
    """Forms to complete requests, with the given ids and times."""
    forms = testbed.requests(tune(spark), sf_dir)
    made = requests.prepare_requests(
        forms, stored_distances(spark, sf_dir), "zero", F.col("UUID"), F.col("Timestamp")
    )
    return made.drop("ts")


QUERIES["prepare_requests"] = prepare_requests
ORACLE["prepare_requests"] = f"""WITH {sql.ENRICHED}
SELECT {sql.cols(SENT)}, "Distance" FROM enriched"""


# Labels and matching.


def _labelled(wording):
    def query(spark, sf_dir):
        rows = testbed.responses(tune(spark), sf_dir)
        return rows.select("UUID", "Prediction", delay_label("Prediction", wording).alias("label"))

    return query


def _label_sql(names):
    cases = " ".join(f"WHEN {number} THEN '{text}'" for number, text in names)
    return f"""WITH {sql.RESPONSES}
SELECT "UUID", "Prediction", CASE "Prediction" {cases} END AS label FROM responses"""


QUERIES["label_results"] = _labelled("polling")
ORACLE["label_results"] = _label_sql(
    [
        (0, "Early (15+ Minutes Early)"),
        (1, "Slightly Early (0-15 Minute Early)"),
        (2, "Slightly Late (0-30 Minute Delay)"),
        (3, "Very Late (30+ Minutes Late)"),
    ]
)
QUERIES["label_results_batch"] = _labelled("batch")
ORACLE["label_results_batch"] = _label_sql(
    [
        (0, "On Time (0-15 Minute Delay)"),
        (1, "Slightly Late (15-60 Minute Delay)"),
        (2, "Very Late (60+ Minute Delay)"),
    ]
)

MATCH = f"""WITH {sql.REQUESTS}, {sql.MIXED_RESPONSES},
first AS (
  SELECT r."UUID", min({{'ts': a.ts, 'p': a."Prediction"}}).p AS "Prediction"
  FROM requests r JOIN responses a
    ON r."UUID" = a."UUID" AND a.ts >= r.ts AND a.ts <= r.ts + INTERVAL 20 SECOND
  GROUP BY r."UUID"
)
SELECT r."UUID", CASE WHEN f."UUID" IS NULL THEN 'WAIT' ELSE 'OK' END AS status, f."Prediction"
FROM requests r LEFT JOIN first f ON r."UUID" = f."UUID\""""


def match_responses(spark, sf_dir):
    """Answers that repeat, come before their request and come too late."""
    answers = testbed.mixed_responses(tune(spark), sf_dir)
    return requests.match_responses(testbed.requests(spark, sf_dir), answers)


QUERIES["match_responses"] = match_responses
ORACLE["match_responses"] = MATCH


# Daily folders and collections.


def _tasks(spark, sf_dir):
    """Requests with their distances, kept as a collection of tasks."""
    path = work_path(spark, "tasks")
    made = dist.with_distance(full_requests(spark, sf_dir).drop("ts"), stored_distances(spark, sf_dir))
    files.append_collection(made, path)
    return path


_BATCH = ", ".join(
    _STAMP if f.name == "Timestamp" else f'"{f.name}"' for f in schemas.BATCH_REQUEST.fields
)
_ON_DAY = f"\"Timestamp\" >= '{DAY}' AND \"Timestamp\" <= '2024-01-16'"


def daily_requests(spark, sf_dir):
    """Collection to the day's folder, and that folder read again."""
    out = work_path(spark, "daily")
    jobs.run_fetch(spark, _tasks(spark, sf_dir), out, DAY)
    return times_as_text(tables.read_requests(spark, out, DAY))


QUERIES["daily_requests"] = daily_requests
ORACLE["daily_requests"] = f"WITH {sql.ENRICHED} SELECT {_BATCH} FROM enriched WHERE {_ON_DAY}"


def _daily_lines(spark, sf_dir):
    """Days of request lines as text, those of error events no JSON."""
    path = work_path(spark, "lines")
    asked = full_requests(spark, sf_dir, keep=("event_type",))
    line = F.when(F.col("event_type") == "error", F.lit(READY)).otherwise(msg.to_message(*[c for c in SENT if c != "UUID"]))
    asked.select(line.alias("value"), F.col("FlightDate").alias("request_date")).write.partitionBy("request_date").text(path)
    return path


def daily_rejects(spark, sf_dir):
    """Lines of all days by whether they decode: good and rejected ones make up all."""
    good, bad = tables.split_json_lines(spark, _daily_lines(spark, sf_dir), schemas.BATCH_REQUEST)
    kinds = [df.select(F.col("request_date").cast("string").alias("day"), F.lit(k).alias("kind")) for k, df in (("good", good), ("rejected", bad))]
    return kinds[0].unionByName(kinds[1]).groupBy("day", "kind").agg(F.count("*").alias("n"))


QUERIES["daily_rejects"] = daily_rejects
ORACLE["daily_rejects"] = f"""WITH {sql.REQUESTS}
SELECT "FlightDate" AS day, CASE WHEN {WELL_FORMED} THEN 'good' ELSE 'rejected' END AS kind, count(*) AS n
FROM requests GROUP BY 1, 2"""


def request_rejects(spark, sf_dir):
    """Forms whose route has no distance, kept apart by the job that prepares the others."""
    forms = testbed.requests(tune(spark), sf_dir).drop("ts")
    known, kept = work_path(spark, "distances"), work_path(spark, "rejects")
    files.write_version(stored_distances(spark, sf_dir), known, dist.ROUTE)
    made = jobs.run_prepare(spark, forms.drop("UUID", "Timestamp"), known, rejects=kept)
    sides = [df.select("Origin", "Dest", F.lit(k).alias("kind")) for k, df in (("good", made), ("rejected", spark.read.parquet(kept)))]
    return sides[0].unionByName(sides[1]).groupBy("Origin", "Dest", "kind").agg(F.count("*").alias("n"))


QUERIES["request_rejects"] = request_rejects
ORACLE["request_rejects"] = f"""WITH {sql.ENRICHED}
SELECT "Origin", "Dest", CASE WHEN found IS NULL THEN 'rejected' ELSE 'good' END AS kind, count(*) AS n
FROM enriched GROUP BY 1, 2, 3"""


def daily_overwrite(spark, sf_dir):
    """All days written, then one day replaced by its first carrier's requests."""
    out = work_path(spark, "daily")
    rows = full_requests(spark, sf_dir).select("UUID", "Carrier", "Origin", "Dest", "FlightDate")
    files.write_days(rows, out, "FlightDate")
    files.write_daily(
        rows.where((F.col("FlightDate") == DAY) & (F.col("Carrier") == "C1")), out, DAY
    )
    return spark.read.schema(rows.schema).json(out).select(*rows.columns)


QUERIES["daily_overwrite"] = daily_overwrite
ORACLE["daily_overwrite"] = f"""WITH {sql.REQUESTS}
SELECT "UUID", "Carrier", "Origin", "Dest", "FlightDate" FROM requests
WHERE "FlightDate" <> '{DAY}' OR "Carrier" = 'C1'"""


def _results(spark, sf_dir):
    """Requests with given predictions."""
    asked = dist.with_distance(full_requests(spark, sf_dir), stored_distances(spark, sf_dir))
    given = testbed.responses(spark, sf_dir).select("UUID", "Prediction")
    return asked.drop("ts").join(given, "UUID")


_RESULTS = f"""{sql.ENRICHED}, {sql.RESPONSES},
results AS (
  SELECT enriched.*, "Prediction" FROM enriched JOIN responses ON enriched."UUID" = responses."UUID"
)"""
_RESULT_COLUMNS = [*SENT, "Distance", "Prediction"]


def decode_results(spark, sf_dir):
    """Result lines as text, decoded."""
    out = work_path(spark, "results")
    files.write_json(_results(spark, sf_dir), out)
    return times_as_text(tables.read_json_text(spark, out, schemas.SCORED))


QUERIES["decode_results"] = decode_results
ORACLE["decode_results"] = f"WITH {_RESULTS} SELECT {_BASE}, \"Distance\", \"Prediction\" FROM results"


def append_results(spark, sf_dir):
    """All days of results loaded one after the other into a collection, the first twice."""
    out, collection = work_path(spark, "results"), work_path(spark, "collection")
    results = _results(spark, sf_dir).drop("UUID")
    day = F.substring("Timestamp", 1, 10)
    files.write_days(results, out, day)
    days = [row.day for row in results.select(day.alias("day")).distinct().orderBy("day").collect()]
    for one in [*days, *days[:1]]:
        jobs.run_load(spark, out, collection, one)
    return tables.read_collection(spark, collection).drop("Route", "request_date")


QUERIES["append_results"] = append_results
ORACLE["append_results"] = f"""WITH {_RESULTS}
SELECT {sql.cols([c for c in _RESULT_COLUMNS if c != "UUID"])} FROM results"""


def daily_results(spark, sf_dir):
    """The page of one day's results."""
    return jobs.results_page(_results(spark, sf_dir), DAY)


QUERIES["daily_results"] = daily_results
ORACLE["daily_results"] = f"""WITH {_RESULTS}
SELECT "Timestamp", "Carrier", "FlightDate", "Origin", "Dest", "Distance", "DepDelay",
  CASE "Prediction" WHEN 0 THEN 'On Time (0-15 Minute Delay)'
    WHEN 1 THEN 'Slightly Late (15-60 Minute Delay)'
    WHEN 2 THEN 'Very Late (60+ Minute Delay)' END AS "PredictedDelay"
FROM results WHERE {_ON_DAY}"""
