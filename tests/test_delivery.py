"""One scoring for several sinks, renewed lookups, replays and waiting."""

import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from skylag.operators.requests import match_responses
from skylag.session import names_in, state_partitions
from skylag.sinks import folders
from skylag.schemas import DISTANCES
from skylag.sources import tables, topics
from skylag.streaming import delivery, scoring, sinks, waiting
from test_streams import message, send

NOW = "available"


def _run(messages, writers, at, score=lambda batch, _: batch.select("value"), **options):
    query = delivery.deliver(messages, score, writers, f"{at}/mark", f"{at}/ledger", trigger=NOW, **options)
    sinks.drain(query)


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_job_that_dies_between_sinks_gives_each_row_once(spark, tmp_path, when):
    topic, at = str(tmp_path / "topic"), str(tmp_path)
    send(spark, topic, [message(i) for i in range(10)])
    calls, dying = [], [True]
    plain = delivery.topic_writer(f"{at}/topic-out")

    def first(batch, n):
        calls.append("first")
        delivery.collection_writer(f"{at}/first")(batch, n)

    def second(batch, n):
        if when == "before" and dying:
            raise RuntimeError(dying.pop())
        plain(batch, n)
        if dying:
            raise RuntimeError(dying.pop())

    def score(batch, _):
        return scoring.enrich_requests(batch, spark.createDataFrame([], DISTANCES))

    for _ in range(3):
        try:
            _run(topics.stream_topic(spark, topic), {"first": first, "second": second}, at, score)
        except StreamingQueryException:
            pass
    want = sorted(f"u{i}" for i in range(10))
    assert calls == ["first"]
    assert sorted(r.UUID for r in spark.read.parquet(f"{at}/first").collect()) == want
    sent = topics.read_topic(spark, f"{at}/topic-out")
    assert sent.count() == (10 if when == "before" else 20)
    assert sorted(r.key for r in delivery.once(sent).collect()) == want
    # A stream of the same topic leaves the doubles out as well.
    seen = delivery.once(topics.stream_topic(spark, f"{at}/topic-out")).select("key")
    with state_partitions(spark, 2):
        sinks.drain(sinks.sink_parquet(seen, f"{at}/seen", f"{at}/seen-mark", NOW))
    assert sorted(r.key for r in spark.read.parquet(f"{at}/seen").collect()) == want


def test_all_rows_of_a_batch_see_one_state_and_a_repeat_the_same(spark, tmp_path):
    topic, known, at = str(tmp_path / "topic"), str(tmp_path / "known"), str(tmp_path)

    def migrate(distance):
        folders.upsert_table(spark.createDataFrame([("A0", "B", distance)], DISTANCES), known, DISTANCES, ["Origin", "Dest"], buckets=2)

    def score(batch, version):
        return scoring.enrich_requests(batch, tables.read_distances(spark, known, version=version)).select("UUID", "Distance")

    dying = [True]

    def late(batch, n):
        if dying:
            migrate(20.0)  # while the batch runs
            raise RuntimeError(dying.pop())
        delivery.collection_writer(f"{at}/late")(batch, n)

    writers = {"early": delivery.collection_writer(f"{at}/early"), "late": late}
    migrate(10.0)
    send(spark, topic, [message(0)])
    for step in range(3):
        if step == 2:
            send(spark, topic, [message(3)])
        try:
            _run(topics.stream_topic(spark, topic), writers, at, score, version=lambda: tables.distances_version(spark, known))
        except StreamingQueryException:
            assert step == 0
    for name in ("early", "late"):
        got = {r.UUID: r.Distance for r in spark.read.parquet(f"{at}/{name}").collect()}
        assert got == {"u0": 10.0, "u3": 20.0}
    assert len(names_in(spark, f"{at}/ledger")) == 1  # one query
    assert len(names_in(spark, f"{at}/ledger/{names_in(spark, f'{at}/ledger')[0]}")) == 1  # its last batch


def test_sinks_need_names_of_their_own(spark, tmp_path):
    with pytest.raises(ValueError, match="names"):
        _run(None, {"a": None}, str(tmp_path), raw_writers={"a": None})


def test_replays_go_on_where_the_last_one_ended(spark, tmp_path):
    topic, offsets = str(tmp_path / "topic"), str(tmp_path / "offsets")

    def values(messages):
        return sorted(r.value for r in messages.collect())

    send(spark, topic, ["a", "b"])
    messages, finish = topics.read_new(spark, topic, offsets)
    send(spark, topic, ["c"])  # after the end was fixed
    assert values(messages) == ["a", "b"]
    assert values(topics.read_new(spark, topic, offsets)[0]) == ["a", "b", "c"]  # not finished
    finish()
    messages, finish = topics.read_new(spark, topic, offsets)
    assert values(messages) == ["c"]
    finish()
    assert values(topics.read_new(spark, topic, offsets)[0]) == []


def _timed(spark, rows, schema):
    return spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_millis(F.col("ms") + 1_000_000_000)).drop("ms")


def test_timers_answer_like_the_join_in_any_order_and_after_restarts(spark, tmp_path):
    dice = random.Random(5)
    asked = [(f"u{i % 40}" if i else None, dice.randint(0, 90_000)) for i in range(80)]
    sent = [(f"u{dice.randint(0, 45)}", dice.randint(0, 120_000), dice.choice([None, 0.0, 1.0, 2.0])) for _ in range(200)] + [(None, asked[0][1], 1.0)]
    asked = _timed(spark, asked + asked[:5], "UUID string, ms long").cache()
    sent = _timed(spark, sent, "UUID string, ms long, Prediction double").cache()
    matched = match_responses(asked.where("UUID is not null"), sent).select("UUID", "status", "Prediction")
    want = sorted(repr(tuple(r)) for r in matched.collect())
    late = _timed(spark, [("late", 10_000_000)], "UUID string, ms long")
    for order in ((0, 1), (1, 0)):
        at = f"{tmp_path}/{order[0]}"
        for step in order:
            part = F.pmod(F.xxhash64("UUID", "ts"), F.lit(2)) == step
            last = step == order[-1]
            for name, rows, end in (("asked", asked, late), ("sent", sent, late.withColumn("Prediction", F.lit(0.0)))):
                rows.where(part).unionByName(end if last else end.limit(0)).coalesce(1).write.mode("append").parquet(f"{at}/{name}")
            streams = [spark.readStream.schema(df.schema).parquet(f"{at}/{n}") for n, df in (("asked", asked), ("sent", sent))]
            with state_partitions(spark, 2):
                sinks.drain(sinks.sink_parquet(waiting.wait_stream(*streams, lateness="300 seconds"), f"{at}/out", f"{at}/mark", NOW))
        rows = spark.read.schema(waiting.MATCHED).parquet(f"{at}/out").where("UUID <> 'late'")
        assert sorted(repr((r.UUID, r.status, r.Prediction)) for r in rows.collect()) == want


def test_an_answer_goes_out_before_the_wait_ends(spark, tmp_path):
    asked = _timed(spark, [("a", 0), ("b", 0), ("c", 30_000)], "UUID string, ms long")
    sent = _timed(spark, [("a", 2_000, 1.0), ("c", 31_000, 2.0)], "UUID string, ms long, Prediction double")
    streams = []
    for name, rows in (("asked", asked), ("sent", sent)):
        rows.coalesce(1).write.parquet(f"{tmp_path}/{name}")
        streams.append(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/{name}"))
    with state_partitions(spark, 2):
        sinks.drain(sinks.sink_parquet(waiting.wait_stream(*streams, wait="20 seconds", lateness="15 seconds"), f"{tmp_path}/out", f"{tmp_path}/mark", NOW))
    # The watermark is at 15 seconds: a's answer is sure, b's wait is not over.
    got = [(r.UUID, r.status) for r in spark.read.schema(waiting.MATCHED).parquet(f"{tmp_path}/out").collect()]
    assert got == [("a", "OK")]


def test_timers_stand_for_groups_of_ids(spark, tmp_path):
    asked = _timed(spark, [(f"u{i}", i) for i in range(60)], "UUID string, ms long")
    sent = _timed(spark, [(f"u{i}", i + 50, float(i)) for i in range(60)], "UUID string, ms long, Prediction double")
    streams = []
    for name, rows in (("asked", asked), ("sent", sent)):
        rows.coalesce(1).write.parquet(f"{tmp_path}/{name}")
        streams.append(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/{name}"))
    with state_partitions(spark, 2):
        query = sinks.sink_parquet(waiting.wait_stream(*streams, groups=3), f"{tmp_path}/out", f"{tmp_path}/mark", NOW)
        sinks.drain(query)
    timers = [p["stateOperators"][0]["customMetrics"]["numRegisteredTimers"] for p in query.recentProgress if p["stateOperators"]]
    assert timers and 0 < max(timers) <= 3


def test_timers_tell_missing_predictions_from_those_that_are_no_number(spark, tmp_path):
    nan = float("nan")
    asked = _timed(spark, [("a", 0), ("b", 0), ("c", 0)], "UUID string, ms long")
    sent = _timed(spark, [("a", 10, nan), ("b", 10, nan), ("b", 10, None), ("c", 10, nan), ("c", 10, 2.0)], "UUID string, ms long, Prediction double")
    late = _timed(spark, [("late", 10_000_000)], "UUID string, ms long")
    streams = []
    for name, rows in (("asked", asked.unionByName(late)), ("sent", sent.unionByName(late.withColumn("Prediction", F.lit(0.0))))):
        rows.coalesce(1).write.parquet(f"{tmp_path}/{name}")
        streams.append(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/{name}"))
    with state_partitions(spark, 2):
        sinks.drain(sinks.sink_parquet(waiting.wait_stream(*streams, groups=1), f"{tmp_path}/out", f"{tmp_path}/mark", NOW))
    rows = spark.read.schema(waiting.MATCHED).parquet(f"{tmp_path}/out").where("UUID <> 'late'")
    assert sorted((r.UUID, r.status, repr(r.Prediction)) for r in rows.collect()) == [("a", "OK", "nan"), ("b", "OK", "None"), ("c", "OK", "2.0")]


def test_the_recovered_fanout_makes_its_distances_once(spark, sf_dir, monkeypatch):
    from skylag.checks import streams

    calls, make = [], streams.stored_distances
    monkeypatch.setattr(streams, "stored_distances", lambda *at: calls.append(at) or make(*at))
    streams.stream_fanout_recovered(spark, sf_dir)
    assert len(calls) == 1
