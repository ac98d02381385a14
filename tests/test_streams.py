"""Streams over file-backed topics, drained and restarted."""

import json
import random

import pytest
from pyspark.sql import functions as F

from skylag import session
from skylag.functions.messages import decode_text
from skylag.operators import model
from skylag.operators.requests import answered, earliest_answer
from skylag.schemas import DISTANCES, SCORED
from skylag.sinks import files
from skylag.sources import testbed, topics
from skylag.streaming import matching, scoring, sinks

NOW = "available"


def message(i, **extra):
    return json.dumps(
        {
            "Origin": f"A{i % 3}", "Dest": "B", "DepDelay": float(i % 60 - 20), "Carrier": "AA",
            "FlightDate": "2016-12-25", "DayOfYear": 360, "DayOfMonth": 25, "DayOfWeek": 6,
            "Timestamp": "2016-12-20T18:06:45", "UUID": f"u{i}", **extra,
        }
    )


def send(spark, topic, values):
    rows = spark.createDataFrame([(None, v) for v in values], "key string, value string")
    files.write_topic(
        rows.select("*", F.lit("t").alias("topic"), F.current_timestamp().alias("timestamp")).coalesce(1),
        topic,
    )


@pytest.fixture(scope="module")
def known(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("d") / "distances")
    spark.createDataFrame([("A0", "B", 10.0), ("A1", "B", 20.0)], DISTANCES).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def fitted(spark):
    i = F.col("id")
    rows = spark.range(200).select(
        (i % 60 - 20).cast("double").alias("DepDelay"), (i % 60 - 20).cast("double").alias("ArrDelay"),
        F.lit(10.0).alias("Distance"), F.lit(25).alias("DayOfMonth"), (i % 7).cast("int").alias("DayOfWeek"),
        F.lit(360).alias("DayOfYear"), F.lit("AA").alias("Carrier"),
        F.concat(F.lit("A"), i % 2).alias("Origin"), F.lit("B").alias("Dest"),
    )
    return model.train(rows, numTrees=3)


def test_scoring_runs_over_several_batches_and_skips_bad_messages(spark, known, fitted, tmp_path):
    topic, out = str(tmp_path / "topic"), str(tmp_path / "out")
    for k in range(3):
        send(spark, topic, [message(i) for i in range(k * 20, k * 20 + 20)] + ["ready", "{"])
    stream = topics.stream_topic(spark, topic, files_per_trigger=1)
    scored = scoring.score_stream(stream, known, fitted)
    query = sinks.sink_parquet(scored, out, str(tmp_path / "mark"), NOW)
    sinks.drain(query)
    assert query.lastProgress["batchId"] >= 2
    rows = spark.read.schema(SCORED).parquet(out).collect()
    assert sorted(r["UUID"] for r in rows) == sorted(f"u{i}" for i in range(60))
    assert {r["Distance"] for r in rows if r["Origin"] == "A2"} == {0.0}
    assert {r["Prediction"] for r in rows} >= {1.0, 2.0}


def test_restart_goes_on_where_it_stopped(spark, known, tmp_path):
    topic, out, mark = (str(tmp_path / n) for n in ("topic", "out", "mark"))
    for step, total in ((range(5), 5), (range(5, 9), 9), ([], 9)):
        if step:
            send(spark, topic, [message(i) for i in step])
        rows = scoring.enrich_requests(topics.stream_topic(spark, topic), known)
        sinks.drain(sinks.sink_collection(rows, out, mark, trigger=NOW))
        assert spark.read.parquet(out).count() == total


def test_sinks_are_independent_and_hold_the_same_rows(spark, known, tmp_path, capfd):
    topic = str(tmp_path / "topic")
    send(spark, topic, [message(i) for i in range(12)])
    rows = scoring.enrich_requests(topics.stream_topic(spark, topic), known).select("UUID", "Distance")
    at = {n: str(tmp_path / n) for n in ("collection", "response", "files")}
    started = sinks.start_sinks(
        rows,
        {
            "collection": lambda d: sinks.sink_collection(d, at["collection"], f"{at['collection']}-c", trigger=NOW),
            "response": lambda d: sinks.sink_topic(d, at["response"], f"{at['response']}-c", trigger=NOW),
            "files": lambda d: sinks.sink_parquet(d, at["files"], f"{at['files']}-c", NOW),
            "console": lambda d: sinks.sink_console(d, NOW),
        },
    )
    sinks.drain(*started.values())
    want = sorted(f"u{i}" for i in range(12))
    sent = topics.read_topic(spark, at["response"])
    assert sorted(r["key"] for r in sent.collect()) == want
    for df in (
        spark.read.parquet(at["collection"]), spark.read.parquet(at["files"]),
        decode_text(sent, rows.schema),
    ):
        assert sorted(r["UUID"] for r in df.collect()) == want


def test_fan_out_computes_once_skips_empty_batches_and_repeats_safely(spark, known, tmp_path):
    topic, out = str(tmp_path / "topic"), str(tmp_path / "out")
    send(spark, topic, [message(i) for i in range(8)])
    rows = scoring.enrich_requests(topics.stream_topic(spark, topic), known)
    calls = []

    def store(batch, n):
        calls.append(n)
        for _ in range(2):  # as after a failure
            batch.write.mode("overwrite").parquet(sinks.batch_folder(out, batch, n))

    sinks.drain(sinks.fan_out(rows, {"a": store}, str(tmp_path / "m1"), NOW))
    assert calls == [0] and spark.read.parquet(out).count() == 8
    none = rows.where("UUID = 'nobody'")
    sinks.drain(sinks.fan_out(none, {"a": store}, str(tmp_path / "m2"), NOW))
    assert calls == [0]
    # A new query on the same folder adds rows instead of replacing the first.
    sinks.drain(sinks.fan_out(rows, {"a": store}, str(tmp_path / "m3"), NOW))
    assert spark.read.parquet(out).count() == 16


def test_callback_scoring_sees_new_distances(spark, fitted, tmp_path):
    topic, out = str(tmp_path / "topic"), str(tmp_path / "out")
    send(spark, topic, [message(0)])
    send(spark, topic, [message(3)])
    asked = []

    def distances():
        asked.append(1)
        return spark.createDataFrame([("A0", "B", 100.0 * len(asked))], DISTANCES)

    stream = topics.stream_topic(spark, topic, files_per_trigger=1)
    apply = scoring.score_batch(distances, fitted, out)
    sinks.drain(sinks.each_batch(stream, apply, str(tmp_path / "mark"), NOW))
    assert sorted(r["Distance"] for r in spark.read.parquet(out).collect()) == [100.0, 200.0]


def test_archive_keeps_messages_as_they_are(spark, tmp_path):
    topic, out = str(tmp_path / "topic"), str(tmp_path / "out")
    sent = [message(1), "ready", "two\nlines", "", None]
    send(spark, topic, sent)
    sinks.drain(sinks.archive_topic(spark, topic, out, str(tmp_path / "mark"), trigger=NOW))
    assert sorted(r["value"] or "" for r in sinks.read_archive(spark, out).collect()) == sorted(s or "" for s in sent)


def test_console_brings_a_few_rows_to_the_driver(spark, tmp_path, capsys):
    topic = str(tmp_path / "topic")
    send(spark, topic, [str(i) * 50 for i in range(500)])
    stream = topics.stream_topic(spark, topic)
    sinks.drain(sinks.sink_console(stream.select("value"), NOW, rows=3))
    assert capsys.readouterr().out.count("|") < 20


def test_periodic_trigger_runs_until_stopped(spark, tmp_path):
    topic, out = str(tmp_path / "topic"), str(tmp_path / "out")
    send(spark, topic, ["ready"])
    query = sinks.archive_topic(spark, topic, out, str(tmp_path / "mark"), trigger="1 seconds")
    try:
        query.processAllAvailable()
        assert spark.read.text(out).count() == 1
    finally:
        query.stop()
    assert not query.isActive


def test_waiting_ends_when_any_query_fails(spark, tmp_path):
    topic = str(tmp_path / "topic")
    send(spark, topic, ["ready"])

    def fail(batch, n):
        raise RuntimeError("sink is gone")

    stream = topics.stream_topic(spark, topic)
    spark.streams.resetTerminated()
    query = sinks.each_batch(stream, fail, str(tmp_path / "mark"))
    with pytest.raises(Exception, match="sink is gone"):
        sinks.run(spark)
    assert not query.isActive
    spark.streams.resetTerminated()


def test_matching_waits_then_gives_up(spark, tmp_path):
    asked = spark.createDataFrame(
        [("fast", 0), ("edge", 0), ("slow", 0), ("never", 1), ("end", 10_000)], "UUID string, s int"
    )
    sent = spark.createDataFrame(
        [("fast", 5, 1.0), ("fast", 6, 3.0), ("edge", 20, 2.0), ("slow", 21, 2.0), ("end", 10_000, 0.0)],
        "UUID string, s int, Prediction double",
    )
    streams = []
    for name, df in (("asked", asked), ("sent", sent)):
        path = str(tmp_path / name)
        # Not from 1970: the first watermark is there, and rows before it are late.
        timed = df.withColumn("ts", F.timestamp_seconds(F.col("s") + 1_000_000)).drop("s")
        timed.coalesce(1).write.parquet(path)
        streams.append(spark.readStream.schema(timed.schema).parquet(path))
    out = str(tmp_path / "out")
    matched = matching.match_stream(*streams).select("UUID", "status", "Prediction")
    sinks.drain(sinks.sink_parquet(matched, out, str(tmp_path / "mark"), NOW))
    got = {r["UUID"]: (r["status"], r["Prediction"]) for r in spark.read.parquet(out).collect()}
    got.pop("end", None)
    assert got.pop("fast")[0] == "OK"
    assert got == {"edge": ("OK", 2.0), "slow": ("WAIT", None), "never": ("WAIT", None)}
    assert spark.read.parquet(out).where("UUID = 'fast'").count() == 1


def test_a_joined_stream_keeps_one_store_a_partition(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1_000_000, 1.0)], "UUID string, s int, Prediction double")
    path = str(tmp_path / "rows")
    rows.select("UUID", F.timestamp_seconds("s").alias("ts"), "Prediction").write.parquet(path)
    streams = [spark.readStream.schema(spark.read.parquet(path).schema).parquet(path) for _ in range(2)]
    mark = tmp_path / "mark"
    with session.state_partitions(spark, 2):
        query = sinks.sink_parquet(matching.match_stream(*streams), str(tmp_path / "out"), str(mark), NOW)
        sinks.drain(query)
    joined = [sorted(p.name for p in op.glob("0/*")) for op in (mark / "state").iterdir() if op.name == "1"]
    assert len(joined) == 1 and not any("keyTo" in name or "keyWith" in name for name in joined[0])


def test_answers_to_match_are_dealt_over_tasks(spark, sf_dir):
    text = testbed.mixed_responses(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE" in text and text.count("md5") == 1


def _sides(spark, at, asked, sent):
    """Streams of requests and answers, given with seconds, in a folder that may hold earlier ones."""
    streams = []
    for name, rows, schema in (("asked", asked, "UUID string, s double"), ("sent", sent, "UUID string, s double, Prediction double")):
        timed = spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds(F.col("s") + 1_000_000)).drop("s")
        timed.coalesce(1).write.mode("append").parquet(f"{at}/{name}")
        streams.append(spark.readStream.schema(timed.schema).parquet(f"{at}/{name}"))
    return streams


def test_the_joined_streams_answer_like_the_tables_in_any_order_and_after_restarts(spark, tmp_path):
    dice = random.Random(7)
    nan = float("nan")
    asked = [(f"u{i % 30}" if i > 1 else None, dice.choice([dice.uniform(0, 90), 20.0 * dice.randint(0, 4)])) for i in range(90)]
    sent = [(f"u{dice.randint(0, 35)}", dice.uniform(0, 120), dice.choice([None, nan, 0.0, 1.0])) for _ in range(150)]
    # At the time of a request, at the end of its wait and just after it; the same time, other predictions.
    sent += [(u, s + d, p) for u, s in asked[:40] for d, p in ((0.0, 2.0), (20.0, 3.0), (20.000001, 4.0))[dice.randint(0, 2):]]
    sent += [(u, s, p) for u, s, _ in sent[:40] for p in (nan, 5.0)] + sent[:20]
    asked += asked[:9]
    for order in ((0, 1), (1, 0)):
        at = tmp_path / str(order[0])
        for step in order:
            last = step == order[-1]
            streams = _sides(
                spark, at, asked[step::2] + [("late", 1e6)] * last, sent[step::2] + [("late", 1e6, 0.0)] * last
            )
            with session.state_partitions(spark, 2):
                matched = matching.match_stream(*streams, lateness="300 seconds", groups=3)
                sinks.drain(sinks.sink_parquet(matched, f"{at}/out", f"{at}/mark", NOW))
        sides = [spark.read.parquet(f"{at}/{name}").where("UUID is null or UUID <> 'late'") for name in ("asked", "sent")]
        answers = sides[1].toDF(*[{"UUID": "_id", "ts": "_at", "Prediction": "_prediction"}[c] for c in sides[1].columns])
        met = sides[0].join(answers, F.expr("_id = UUID AND _at BETWEEN ts AND ts + INTERVAL 20 SECONDS"), "left")
        want = answered(met.groupBy("UUID", "ts").agg(earliest_answer()))
        got = spark.read.schema("UUID string, ts timestamp, status string, Prediction double").parquet(f"{at}/out")
        got = got.where("UUID is null or UUID <> 'late'")
        assert got.count() == sides[0].distinct().count()
        rows = [sorted(repr(tuple(r)) for r in df.select("UUID", "ts", "status", "Prediction").collect()) for df in (got, want)]
        assert rows[0] == rows[1]


def test_state_of_joined_streams_is_kept_by_windows_and_groups(spark, tmp_path):
    asked = [(f"u{i}", i / 20) for i in range(300)]
    streams = _sides(spark, tmp_path, asked, [(u, s + 3, 1.0) for u, s in asked])
    with session.state_partitions(spark, 2):
        query = sinks.sink_parquet(matching.match_stream(*streams, groups=4), f"{tmp_path}/out", f"{tmp_path}/mark", NOW)
        sinks.drain(query)
    # One window of requests and two of answers, four groups each.
    first = [p for p in query.recentProgress if p["numInputRows"]][0]
    assert 0 < sum(op["numRowsUpdated"] for op in first["stateOperators"]) <= 12
