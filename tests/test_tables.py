"""Distances, features, searches, pages and summaries on small fixtures."""

import random
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from skylag.operators import distances as dist
from skylag.operators import features as feat
from skylag.operators import lookups, requests, summaries
from skylag.schemas import DISTANCES
from skylag.sources import testbed


def test_last_write_of_a_key_wins(spark):
    stored = spark.createDataFrame([("A", "B", 1.0), ("A", "C", 2.0)], DISTANCES)
    changes = spark.createDataFrame(
        [("A", "B", 9.0, 2), ("A", "B", 50.0, 1), ("A", "D", 4.0, 1)],
        "Origin string, Dest string, Distance double, seq int",
    )
    merged = dist.upsert(stored, changes, dist.ROUTE, "seq")
    assert {tuple(r) for r in merged.collect()} == {
        ("A", "B", 9.0), ("A", "C", 2.0), ("A", "D", 4.0),
    }


def test_missing_distance_is_zero_in_the_table(spark):
    rows = spark.createDataFrame([("A", "B", None)], DISTANCES)
    assert dist.select_distances(rows).first()["Distance"] == 0.0


@pytest.fixture(scope="module")
def asked(spark):
    return spark.createDataFrame(
        [("A", "B", 5.0), ("A", "X", 5.0), (None, "B", 5.0)],
        "Origin string, Dest string, Distance double",
    )


@pytest.fixture(scope="module")
def known(spark):
    return spark.createDataFrame([("A", "B", 1.0), ("A", "C", 2.0)], DISTANCES)


def test_lookup_modes(spark, asked, known):
    zero = dist.with_distance(asked, known, "zero").collect()
    assert sorted(r["Distance"] for r in zero) == [0.0, 0.0, 1.0]
    assert dist.with_distance(asked, known, "drop").count() == 1
    with pytest.raises(PySparkException, match="no distance for route"):
        dist.with_distance(asked, known, "error").collect()
    missing = dist.routes_without_distance(asked, known).collect()
    assert {tuple(r) for r in missing} == {("A", "X"), (None, "B")}


def test_route_is_null_without_an_end(spark, asked):
    routes = [r["Route"] for r in feat.with_route(asked).collect()]
    assert routes == ["A-B", "A-X", None]


def test_null_profile_counts_all_columns_in_one_job(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, None)], "a int, b string").withColumn(
        "c", F.lit(1)
    )
    assert {tuple(r) for r in feat.null_profile(df).collect()} == {("a", 1), ("b", 3)}


def test_tie_spreads_copies_over_ranges(spark):
    same = spark.range(0, 4000, numPartitions=4).select(
        *[F.when(F.col("id") >= 0, "x").alias(c) for c in feat.SORT_KEYS],
        F.xxhash64("id").alias("RowKey"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        def widest(df):
            places = df.select(F.spark_partition_id()).collect()
            return max(Counter(p[0] for p in places).values())

        assert widest(feat.sort_features(same)) == 4000
        assert widest(feat.sort_features(same, "RowKey")) < 2500
        assert "RowKey" not in feat.sort_features(same, "RowKey").columns
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


# Searches.


@pytest.fixture(scope="module")
def planes(spark):
    return spark.createDataFrame(
        [
            ("N1", "Blue Sky Air", "BOEING"),
            ("N2", "sky-high", "AIRBUS"),
            ("N3", "Red Air", "BOEING"),
            ("N4", None, "BOEING"),
        ],
        "TailNum string, Owner string, Manufacturer string",
    )


def test_words_match_without_case_or_punctuation(planes):
    found = lookups.search_airplanes(planes, Owner="SKY, air!").collect()
    assert {r["TailNum"]: r["Relevance"] for r in found} == {"N1": 2, "N2": 1, "N3": 1}
    both = lookups.search_airplanes(planes, Owner="air", Manufacturer="boeing", Model="").collect()
    assert {r["TailNum"]: r["Relevance"] for r in both} == {"N1": 2, "N3": 2}


def test_search_rejects_unknown_fields(planes):
    with pytest.raises(ValueError):
        lookups.search_airplanes(planes, Colour="red")


def test_no_fields_find_everything(planes):
    assert lookups.search_airplanes(planes).count() == 4


# Pages.


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    data = [
        (rng.choice([None, "a", "b", "c"]), rng.choice([None, 1, 2, 3]), rng.choice([1.5, 2.5]))
        for _ in range(400)
    ]
    data += [("b", 2, 1.5)] * 200
    return spark.createDataFrame(data, "k string, n int, x double"), data


@pytest.fixture(scope="module")
def orders(rows, tmp_path_factory):
    paths = {}
    for falling in (False, True):
        paths[falling] = str(tmp_path_factory.mktemp("order") / "rows")
        lookups.write_order(rows[0], paths[falling], ["k", "n"], ["n"] if falling else [])
    return paths


def by_brute_force(data, falling):
    def up(v):
        return (v is not None, v if v is not None else 0)

    ordered = sorted(data, key=lambda r: up(r[2]))
    ordered = sorted(ordered, key=lambda r: up(r[1]), reverse=falling)
    return sorted(ordered, key=lambda r: up(r[0]) if r[0] is None else (True, r[0]))


@pytest.mark.parametrize("falling", [False, True])
@pytest.mark.parametrize("start", [0, 5, 99, 250, 333, 480, 590, 599, 600, 5000])
def test_pages_equal_slices_of_the_sorted_rows(spark, rows, orders, falling, start):
    df, data = rows
    desc = ["n"] if falling else []
    want = by_brute_force(data, falling)[start : start + 15]
    assert [tuple(r) for r in lookups.page(df, ["k", "n"], start, 15, descending=desc).collect()] == want
    stored = lookups.stored_page(spark, orders[falling], ["k", "n"], start, 15, desc)
    assert [tuple(r) for r in stored.collect()] == want


@pytest.mark.parametrize("falling", [False, True])
def test_search_after_goes_through_all_different_rows(rows, falling):
    df, data = rows
    desc = ["n"] if falling else []
    want = list(dict.fromkeys(by_brute_force(data, falling)))
    seen = [lookups.page(df.distinct(), ["k", "n"], 0, 5, desc).collect()]
    while seen[-1]:
        seen.append(lookups.search_after(df.distinct(), ["k", "n"], seen[-1][-1].asDict(), 5, desc).collect())
    assert [tuple(r) for part in seen for r in part] == want


def test_page_at_row_a_million(spark, tmp_path):
    path = str(tmp_path / "order")
    hot = spark.range(1_200_000).select(F.lit("hot").alias("k"), F.col("id").alias("n"))
    lookups.write_order(hot, path, ["k"])
    got = lookups.stored_page(spark, path, ["k"], 1_000_000, 3)
    assert [r["n"] for r in got.collect()] == [1_000_000, 1_000_001, 1_000_002]


def test_page_bounds(spark):
    df = spark.createDataFrame([(20,)], "total int")
    first = lookups.page_bounds(df, 0, 15, 15).first()
    assert (first["previous_bottom"], first["previous_top"]) == (0, 0)
    assert not first["previous_link"] and first["next_link"]
    last = lookups.page_bounds(df, 15, 30, 15).first()
    assert (last["next_bottom"], last["next_top"]) == (30, 45)
    assert last["previous_link"] and not last["next_link"]


def test_day_range_is_text_with_both_ends(spark):
    stamps = [
        "2016-12-24T23:59:59", "2016-12-25", "2016-12-25T00:00:00", "2016-12-25T23:59:59",
        "2016-12-26", "2016-12-26T00:00:00",
    ]
    df = spark.createDataFrame([(s,) for s in stamps], "Timestamp string")
    assert [r[0] for r in lookups.on_day(df, "2016-12-25").collect()] == stamps[1:5]


def test_list_of_flights_is_ordered_and_counted(spark):
    df = spark.createDataFrame(
        [("A", "B", "d", "0900", "1000"), ("A", "B", "d", None, "0100"), ("A", "B", "d", "0900", "0930"),
         ("A", "C", "d", "0800", "0900")],
        "Origin string, Dest string, FlightDate string, DepTime string, ArrTime string",
    )
    found = lookups.list_flights(df, "A", "B", "d").collect()
    assert [(r["DepTime"], r["ArrTime"]) for r in found] == [(None, "0100"), ("0900", "0930"), ("0900", "1000")]
    assert {r["total"] for r in found} == {3}


# Airplanes and fleets.


def test_copies_fold_and_every_flight_is_kept(spark):
    hot = [("HOT", "2024-01-01", str(i), "C", "A", "B") for i in range(900)]
    copies = [("DUP", "2024-01-01", "7", "C", "A", "B")] * 700
    cold = [("COLD", "2024-01-02", "1", "C", "A", "B"), (None, "2024-01-02", "1", "C", "A", "B")]
    df = spark.createDataFrame(
        hot + copies + cold,
        "TailNum string, FlightDate string, FlightNum string, Carrier string, Origin string, Dest string",
    )
    table = summaries.flights_per_airplane(df)
    rows = {(r["TailNum"], r["FlightNum"]): r["Copies"] for r in table.collect()}
    assert len(rows) == 903 and sum(rows.values()) == len(hot + copies + cold)
    assert rows[("DUP", "7")] == 700
    page = lookups.airplane_flights(table, "HOT", 890, 15).collect()
    assert [r["FlightNum"] for r in page] == sorted(str(i) for i in range(900))[890:]


def test_fleet_lists_each_airplane_once(spark):
    df = spark.createDataFrame(
        [("AA", "N2"), ("AA", "N1"), ("AA", "N2"), ("DL", "N9"), ("DL", None)],
        "Carrier string, TailNum string",
    )
    fleets = summaries.airplanes_per_carrier(df)
    assert [r["TailNum"] for r in lookups.fleet_page(fleets, "AA").collect()] == ["N1", "N2"]
    assert {tuple(r) for r in lookups.list_carriers(fleets).collect()} == {("AA", 2), ("DL", 1)}
    airlines = spark.createDataFrame([("AA",), ("ZZ",)], "CarrierCode string")
    assert {tuple(r) for r in lookups.airline_page(airlines, fleets).collect()} == {("AA", 2), ("ZZ", None)}


def test_chart_is_ordered(spark, planes):
    chart = summaries.chart_rows(summaries.manufacturer_totals(planes), "Manufacturer", "Total")
    assert [tuple(d) for d in chart.collect()] == [("BOEING", 3), ("AIRBUS", 1)]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(x,) for x in (-20.0, -15.0, -1.0, 0.0, 30.0, None)], "ArrDelay double")
    bins = {r["label"]: r["value"] for r in summaries.delay_histogram(df, [-15, 0, 30]).collect()}
    assert bins == {"< -15": 1, "-15 to 0": 2, "0 to 30": 1, ">= 30": 1}
    empty = {r["label"]: r["value"] for r in summaries.delay_histogram(df.limit(0), [0]).collect()}
    assert empty == {"< 0": 0, ">= 0": 0}


# Requests and responses.


def test_form_fields_that_cannot_be_read_are_null(spark):
    df = spark.createDataFrame(
        [("5", "AA", "d", "B", "1", "A"), ("five", "AA", "d", "B", "1", "A"), (None, "AA", "d", "B", "1", "A")],
        "DepDelay string, Carrier string, FlightDate string, Dest string, FlightNum string, Origin string",
    )
    assert [r["DepDelay"] for r in requests.coerce_request(df).collect()] == [5.0, None, None]
    whole = requests.coerce_request(df, requests.REGRESSION_FIELDS)
    assert dict(whole.dtypes)["DepDelay"] == "int"


def test_prepared_requests_get_ids_and_times(spark, known):
    form = spark.createDataFrame(
        [("5", "AA", "2016-12-25", "B", "1", "A")],
        "DepDelay string, Carrier string, FlightDate string, Dest string, FlightNum string, Origin string",
    )
    row = requests.prepare_requests(form, known).first()
    assert row["Distance"] == 1.0 and row["DayOfWeek"] == 6
    assert len(row["UUID"]) == 36 and row["Timestamp"][10] == "T"


def test_first_response_in_time_counts(spark):
    asked = spark.createDataFrame([("a", 0), ("b", 0), ("c", 0), ("d", 100)], "UUID string, s int")
    sent = spark.createDataFrame(
        [("a", 20, 1.0), ("a", 5, 3.0), ("b", 21, 2.0), ("d", 99, 1.0), ("d", 105, 2.0), ("z", 1, 1.0)],
        "UUID string, s int, Prediction double",
    )
    at = F.timestamp_seconds("s")
    got = requests.match_responses(
        asked.select("UUID", at.alias("ts")), sent.select("UUID", at.alias("ts"), "Prediction")
    )
    assert {r["UUID"]: (r["status"], r["Prediction"]) for r in got.collect()} == {
        "a": ("OK", 3.0), "b": ("WAIT", None), "c": ("WAIT", None), "d": ("OK", 2.0),
    }


def test_requests_of_one_row_group_are_dealt_over_tasks(spark, tmp_path):
    events = spark.range(40_000).selectExpr(
        "id AS event_id", "id % 77 AS user_id", "rand(3) AS value", "timestamp_ntz '1996-02-02 10:00:00' AS ts"
    )
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    asked = testbed.requests(spark, str(tmp_path))
    sizes = Counter(r.part for r in asked.select("*", F.spark_partition_id().alias("part")).collect())
    assert len(sizes) > 1 and max(sizes.values()) < 30_000 and sum(sizes.values()) == 40_000
    assert asked.select("UUID").distinct().count() == 40_000
