import json

import pytest
from pyspark.sql import functions as F

from skylag import schemas
from skylag.functions import messages as msg
from skylag.functions.labels import delay_label
from skylag.streaming.scoring import enrich_requests

GOOD = {
    "Origin": "ATL", "Dest": "ORD", "DepDelay": -100.0, "Carrier": "AA", "FlightNum": "2010",
    "FlightDate": "2016-12-25", "DayOfYear": 360, "DayOfMonth": 25, "DayOfWeek": 6,
    "Distance": 606.0, "Timestamp": "2016-12-20T18:06:45.307114", "UUID": "a01b",
}


def topic(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_good_and_bad_messages_part(spark):
    sent = [
        json.dumps(GOOD),
        "ready",
        json.dumps({**GOOD, "UUID": "b", "DayOfYear": "many"}),
        json.dumps({**GOOD, "UUID": "c", "FlightNum": 2010, "Route": "ATL-ORD"}),
        json.dumps({"Origin": "ATL"}),
        "",
        None,
    ]
    good, bad = msg.split_malformed(topic(spark, *sent))
    kept = {r["UUID"]: r for r in good.collect()}
    assert set(kept) == {"a01b", "b", "c"}
    assert kept["b"]["DayOfYear"] is None and kept["b"]["DepDelay"] == -100.0
    assert kept["c"]["FlightNum"] == "2010"
    rest = sorted(r["value"] or "" for r in bad.collect())
    assert rest == ["", "", "ready", '{"Origin": "ATL"}']


def test_binary_values_decode(spark):
    df = topic(spark, json.dumps(GOOD)).select(F.col("value").cast("binary").alias("value"))
    row = msg.parse_requests(df).first()
    assert row.asDict().keys() == set(schemas.REQUEST_COLUMNS)
    assert row["Origin"] == "ATL"


def test_distance_of_the_message_gives_way_to_the_table(spark):
    known = spark.createDataFrame([("ATL", "ORD", 600.0)], schemas.DISTANCES)
    sent = topic(spark, json.dumps(GOOD), json.dumps({**GOOD, "UUID": "b", "Dest": "XXX"}))
    rows = {r["UUID"]: r for r in enrich_requests(sent, known).collect()}
    assert rows["a01b"]["Distance"] == 600.0
    assert rows["b"]["Distance"] == 0.0
    assert rows["a01b"]["Route"] == "ATL-ORD"


def test_messages_are_decoded_once(spark):
    plan = msg.parse_requests(topic(spark, json.dumps(GOOD)).repartition(2))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1


def test_encoding_drops_nulls_and_cuts_to_milliseconds(spark):
    row = spark.createDataFrame([("a",)], "UUID string").select(
        "UUID",
        F.lit(None).cast("double").alias("Distance"),
        F.expr("TIMESTAMP'2016-12-20T18:06:45.307114Z'").alias("Timestamp"),
    )
    sent = msg.keyed_messages(row).first()
    assert sent["key"] == "a"
    assert sent["value"] == '{"UUID":"a","Timestamp":"2016-12-20T18:06:45.307Z"}'


def test_encode_then_decode_gives_the_same_rows(spark):
    rows = spark.createDataFrame(
        [("A", 1, 2, 3, "B", 1.5, None, None, "C", "id", 7.0, 2.0)], schemas.SCORED
    ).withColumn("Timestamp", F.expr("TIMESTAMP'2024-01-01T00:00:00.123Z'"))
    again = msg.decode_text(msg.keyed_messages(rows), schemas.SCORED)
    assert again.collect() == rows.collect()


@pytest.mark.parametrize(
    "number, polling, batch",
    [
        ("0", "Early (15+ Minutes Early)", "On Time (0-15 Minute Delay)"),
        ("1.0", "Slightly Early (0-15 Minute Early)", "Slightly Late (15-60 Minute Delay)"),
        ("2", "Slightly Late (0-30 Minute Delay)", "Very Late (60+ Minute Delay)"),
        ("3.0", "Very Late (30+ Minutes Late)", None),
        ("x", None, None),
    ],
)
def test_labels(spark, number, polling, batch):
    row = spark.createDataFrame([(number,)], "p string").select(
        delay_label("p").alias("a"), delay_label("p", "batch").alias("b")
    ).first()
    assert (row["a"], row["b"]) == (polling, batch)
