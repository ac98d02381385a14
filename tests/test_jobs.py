"""The jobs from flights to stored predictions, end to end."""

import glob

import pytest
from pyspark.sql import functions as F

from skylag.operators import features as feat
from skylag.plans import jobs
from skylag.sinks import files, folders
from skylag.sources import tables, testbed, topics
from skylag.streaming import sinks

DAY = "2024-01-15"


@pytest.fixture(scope="module")
def base(tmp_path_factory):
    return str(tmp_path_factory.mktemp("jobs"))


@pytest.fixture(scope="module")
def flights(spark, sf_dir, base):
    path = f"{base}/flights"
    testbed.flights(spark, sf_dir).write.parquet(path)
    return path


@pytest.fixture(scope="module")
def trained(spark, flights, base):
    jobs.run_extract(spark, flights, f"{base}/features")
    report = jobs.run_train(
        spark, f"{base}/features", f"{base}/model", f"{base}/classes", numTrees=3, max_bins=700
    )
    return f"{base}/model", report


@pytest.fixture(scope="module")
def distances(spark, flights, base):
    jobs.run_distances(spark, flights, f"{base}/distances-json", n_files=1)
    jobs.run_migrate(spark, f"{base}/distances-json", f"{base}/distances")
    jobs.run_migrate(spark, f"{base}/distances-json", f"{base}/distances")
    return f"{base}/distances"


def test_extract_writes_all_flights_with_known_delays(spark, flights, base, trained):
    known = feat.drop_unknown_delays(tables.read_flights(spark, flights)).count()
    stored = tables.read_features(spark, f"{base}/features")
    assert stored.count() == known
    assert stored.where(F.col("CRSArrTime") < F.col("CRSDepTime")).count() == 0
    assert any(f.endswith(".bz2") for f in stored.inputFiles())


def test_extract_packs_in_small_blocks(spark, base, trained):
    names = glob.glob(f"{base}/features/part-*.json.bz2")
    assert {open(n, "rb").read(4) for n in names} == {b"BZh1"}


def test_features_as_columns_train_the_same_way(spark, flights, base, trained):
    jobs.run_extract(spark, flights, f"{base}/features-p", fmt="parquet")
    report = jobs.run_train(
        spark, f"{base}/features-p", f"{base}/model-p", f"{base}/classes-p",
        numTrees=2, max_bins=700, fmt="parquet",
    )
    assert sum(report.predicted.values()) == sum(trained[1].predicted.values())


def test_extract_samples_before_filtering(spark, flights, base):
    jobs.run_extract(spark, flights, f"{base}/sampled", fraction=0.1)
    part = tables.read_features(spark, f"{base}/sampled").count()
    whole = tables.read_flights(spark, flights).count()
    assert 0.05 * whole < part < 0.15 * whole


def test_training_reports(trained):
    _, report = trained
    assert report.nulls == {}
    assert 0.4 < report.accuracy <= 1
    assert sum(report.predicted.values()) > 1000
    assert report.sample.count() <= 6


def test_training_with_a_share_apart(spark, base, trained):
    report = jobs.run_train(
        spark, f"{base}/features", f"{base}/model2", f"{base}/classes2",
        holdout=0.3, numTrees=2, max_bins=700,
    )
    assert sum(report.predicted.values()) < sum(trained[1].predicted.values()) / 2


def test_distances_are_sorted_text_and_a_keyed_table(spark, base, distances):
    lines = [r["Distance"] for r in tables.read_distances(spark, f"{base}/distances-json", "json").collect()]
    assert lines == sorted(lines)
    stored = tables.read_distances(spark, distances)
    assert stored.count() == len(lines) == stored.select("Origin", "Dest").distinct().count()


def test_daily_jobs_from_tasks_to_the_results_page(spark, sf_dir, base, trained, distances):
    forms = testbed.requests(spark, sf_dir).drop("ts", "UUID", "Timestamp").limit(50)
    made = jobs.run_prepare(spark, forms, distances, tasks=f"{base}/tasks", on_missing="zero")
    today = made.first()["Timestamp"][:10]
    for _ in range(2):  # running a day again replaces it
        jobs.run_fetch(spark, f"{base}/tasks", f"{base}/daily", today)
        jobs.run_daily_scoring(spark, f"{base}/daily", trained[0], f"{base}/results", today)
    for _ in range(2):  # so does loading it
        jobs.run_load(spark, f"{base}/results", f"{base}/collection", today)
    stored = tables.read_collection(spark, f"{base}/collection")
    assert stored.count() == 50
    assert {"Route", "Prediction"} <= set(stored.columns)
    page = jobs.results_page(stored, today)
    assert page.count() == 50
    assert page.columns[-1] == "PredictedDelay"


@pytest.mark.parametrize("independent", [False, True])
def test_continuous_job_with_all_sinks(spark, sf_dir, base, trained, distances, independent, capsys):
    at = f"{base}/continuous-{independent}"
    forms = testbed.requests(spark, sf_dir).drop("ts", "UUID", "Timestamp").limit(40)
    made = jobs.run_prepare(spark, forms, distances, topic=f"{at}/request", on_missing="drop")
    started = jobs.run_stream_scoring(
        spark, f"{at}/request", distances, trained[0], f"{at}/response", f"{at}/scored",
        f"{at}/archive", f"{at}/marks", trigger="available", independent=independent, console=not independent,
    )
    assert set(started) == ({"collection", "topic", "files"} if independent else {"scored"})
    sinks.drain(*started.values())
    ids = sorted(r["UUID"] for r in made.collect())
    assert sorted(r["key"] for r in topics.read_topic(spark, f"{at}/response").collect()) == ids
    for path in (f"{at}/scored", f"{at}/archive"):
        assert sorted(r["UUID"] for r in spark.read.parquet(path).collect()) == ids
    assert independent or capsys.readouterr().out.count("|") > 20


def test_bad_lines_and_missing_days(spark, base, trained):
    day = "2024-03-01"
    good = '{"Carrier":"C1","Origin":"A01","Dest":"A02","DayOfMonth":1,"DayOfWeek":4,"DayOfYear":61,"DepDelay":5.0,"Distance":100.0,"FlightNum":"1"}'
    lines = spark.createDataFrame([(good,), ("ready",), ("",), ("{}",), ("[1]",)], "value string")
    lines.write.text(f"{base}/bad/request_date={day}")
    assert jobs.run_daily_scoring(spark, f"{base}/bad", trained[0], f"{base}/bad-out", day, f"{base}/bad-side") == 4
    assert spark.read.json(f"{base}/bad-out").count() == 1
    assert spark.read.text(f"{base}/bad-side").count() == 4
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jobs.run_daily_scoring(spark, f"{base}/bad", trained[0], f"{base}/bad-out", "2024-03-02")
    assert spark.read.json(f"{base}/bad-out").count() == 1


def test_minutes_are_trained_stored_and_scored(spark, base, trained):
    day = "2024-03-01"
    row = '{"Carrier":"C1","Origin":"A01","Dest":"A02","DayOfMonth":1,"DayOfWeek":4,"DayOfYear":61,"DepDelay":5.0,"Distance":100.0,"FlightNum":"1"}'
    spark.createDataFrame([(row,)], "value string").write.text(f"{base}/minutes-in/request_date={day}")
    jobs.run_train_minutes(spark, f"{base}/features", f"{base}/minutes")
    assert jobs.run_minutes(spark, f"{base}/minutes-in", f"{base}/minutes", f"{base}/minutes-out", day) == 0
    got = spark.read.json(f"{base}/minutes-out").first()
    assert got["DayOfWeek"] == 4 and -100 < got["Delay"] < 200


def test_readers_of_a_version_survive_the_next(spark, base, distances):
    before = tables.read_distances(spark, distances)
    rows = before.count()
    jobs.run_migrate(spark, f"{base}/distances-json", distances)
    assert before.count() == rows
    assert not set(tables.read_distances(spark, distances).inputFiles()) & set(before.inputFiles())


def test_a_table_in_versions_is_taken_over(spark, base, distances):
    old = tables.read_distances(spark, distances)
    files.write_version(old.withColumn("Distance", F.lit(1.0)).where("Origin <> 'A01'"), f"{base}/versions", ["Origin", "Dest"])
    old.where("Origin = 'A01'").write.json(f"{base}/some-json")
    jobs.run_migrate(spark, f"{base}/some-json", f"{base}/versions")
    rows = tables.read_distances(spark, f"{base}/versions")
    assert rows.count() == old.count() and rows.where("Origin <> 'A01' AND Distance <> 1.0").count() == 0
    assert rows.where("Origin = 'A01'").exceptAll(old).count() == 0


def test_old_states_of_a_table_are_removed(spark, base, distances):
    before = sorted(map(tuple, tables.read_distances(spark, distances).collect()))
    jobs.run_clean(spark, distances, keep=1)
    jobs.run_clean(spark, distances, keep=1)
    assert sorted(map(tuple, tables.read_distances(spark, distances).collect())) == before
    assert len(folders.commits(spark, distances)) == 1


def test_jobs_have_a_command(spark, flights, base, trained):
    from skylag import __main__ as command

    given = vars(command.parser().parse_args(["train", "--features-path", "f", "--model-path", "m", "--bucketizer-path", "b", "--holdout", "0.2"]))
    assert (given["job"], given["features_path"], given["holdout"]) == ("train", "f", 0.2)
    given = vars(command.parser().parse_args(["fetch", "--tasks", "t", "--out", "o", "--day", "d", "--options", "database=flights,uri=mongodb://h"]))
    assert given["passed_on"] == {"database": "flights", "uri": "mongodb://h"}
    command.main(["train", "--features-path", f"{base}/features-p", "--model-path", f"{base}/m", "--bucketizer-path", f"{base}/b", "--fmt", "parquet", "--options", "numTrees=2,maxDepth=3,bootstrap=false"])
    with pytest.raises(SystemExit, match="given twice: day"):
        command.main(["load", "--results-path", "r", "--collection", "c", "--day", "d", "--options", "day=e"])
    command.main(["distances", "--flights-path", flights, "--out", f"{base}/by-command"])
    assert spark.read.json(f"{base}/by-command").count() > 0
