"""What the planner makes of the operators: pushdown, pruning, joins, skew."""

import contextlib

import pytest
from pyspark.sql import functions as F

from skylag import session
from skylag.operators import distances as dist
from skylag.operators import features as feat
from skylag.operators import lookups, requests, summaries
from skylag.sources import tables, testbed


@contextlib.contextmanager
def settings(spark, **conf):
    names = {k.replace("__", "."): v for k, v in conf.items()}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df, run=False):
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def flights(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("p") / "flights")
    testbed.flights(spark, sf_dir).write.parquet(path)
    return tables.read_flights(spark, path)


def test_search_filters_reach_the_scan(flights):
    text = plan(lookups.search_flights(flights, Carrier="C1", Origin="A03"))
    assert "EqualTo(Carrier,C1)" in text and "EqualTo(Origin,A03)" in text
    assert "Exchange" not in text


def test_aggregates_read_only_their_columns(flights):
    text = plan(dist.route_distances(flights))
    assert "ReadSchema: struct<Origin:string,Dest:string,Distance:double>" in text
    assert "partial_avg" in text
    text = plan(summaries.flights_by_month(flights))
    assert "ReadSchema: struct<Year:int,Month:int>" in text


def test_features_take_one_shuffle_and_no_python(flights):
    text = plan(feat.sort_features(feat.extract_features(flights)))
    assert text.count("Exchange") == 1 and "rangepartitioning" in text
    assert "Python" not in text
    assert "IsNotNull(ArrDelay)" in text


def test_pages_are_top_n(flights):
    text = plan(lookups.page(flights, lookups.FLIGHT_ORDER, 30, 15))
    assert "TakeOrderedAndProject" in text and "Window" not in text


def test_totals_do_not_gather_rows(flights):
    text = plan(lookups.flights_page(flights, Carrier="C1"))
    assert "Window" not in text and "NestedLoop" not in text and "Cartesian" not in text


def test_small_lookup_is_broadcast_and_large_is_not(spark, flights, tmp_path):
    path = str(tmp_path / "d")
    dist.route_distances(flights).write.parquet(path)
    known = tables.read_distances(spark, path)
    asked = flights.select("Origin", "Dest")
    small = plan(dist.with_distance(asked, known), run=True)
    assert "BroadcastHashJoin" in small and "hashpartitioning" not in small
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        assert "SortMergeJoin" in plan(dist.with_distance(asked, known), run=True)


SKEW = dict(
    spark__sql__autoBroadcastJoinThreshold="-1",
    spark__sql__adaptive__coalescePartitions__enabled="false",
    spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
    spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
    spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
)


def test_hot_route_is_split(spark, flights, tmp_path):
    asked = spark.range(0, 60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "A03").otherwise(F.concat(F.lit("A"), F.col("id"))).alias("Origin"),
        F.lit("A07").alias("Dest"), F.xxhash64("id").alias("x"),
    )
    known = dist.route_distances(flights)
    with settings(spark, **SKEW):
        joined = dist.with_distance(asked, known)
        assert "skew=true" in plan(joined, run=True)
        assert joined.count() == 60_000


def test_airplanes_fold_before_the_shuffle(flights):
    text = plan(summaries.flights_per_airplane(flights))
    assert "partial_count" in text and "collect_list" not in text


def test_one_airplane_is_looked_up_in_the_scan(spark, flights, tmp_path):
    path = str(tmp_path / "airplanes")
    summaries.flights_per_airplane(flights).write.parquet(path)
    text = plan(lookups.airplane_flights(spark.read.parquet(path), "N00042"))
    assert "EqualTo(TailNum,N00042)" in text and "TakeOrderedAndProject" in text


def test_repeated_responses_fold_before_the_shuffle(spark):
    sent = spark.range(0, 1000).select(
        F.lit("same").alias("UUID"), F.timestamp_seconds("id").alias("ts"), F.lit(1.0).alias("Prediction")
    )
    text = plan(requests.match_responses(sent.select("UUID", "ts").limit(1), sent))
    assert text.count("partial_min") == 2


def test_upsert_needs_no_window(spark, flights):
    changes = flights.select("Origin", "Dest", "Distance", F.col("FlightDate").alias("seq"))
    merged = dist.upsert(dist.route_distances(flights), changes, dist.ROUTE, "seq")
    text = plan(merged)
    assert "Window" not in text and "partial_max" in text


def test_state_partitions_are_set_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session.state_partitions(spark, 3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert session.work_path(spark, "x").startswith(root + "/x-")
    assert session.work_path(spark, "x") != session.work_path(spark, "x")


def test_shuffles_are_merged_up_to_a_size_that_a_session_may_lower(spark):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    for given, kept in (("64MB", "16MB"), ("8m", "8m")):
        with settings(spark, **{name.replace(".", "__"): given}):
            assert session.tune(spark).conf.get(name) == kept
