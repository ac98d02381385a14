"""Classes, indexes, vectors, models and the jobs around them."""

import pytest
from pyspark.sql import functions as F

from skylag.operators import features as feat
from skylag.operators import model
from skylag.streaming import scoring
from skylag.functions.messages import to_message
from skylag.schemas import DISTANCES, SCORED


@pytest.fixture(scope="module")
def features(spark):
    """Late departures arrive late; routes and carriers come unevenly often."""
    i = F.col("id")
    airport = F.concat(F.lit("A"), i % 5)
    return spark.range(0, 600, numPartitions=3).select(
        (i % 80 - 25).cast("double").alias("DepDelay"),
        (i % 80 - 22).cast("double").alias("ArrDelay"),
        ((i % 5) * 100 + 50).cast("double").alias("Distance"),
        (i % 28 + 1).cast("int").alias("DayOfMonth"),
        (i % 7 + 1).cast("int").alias("DayOfWeek"),
        (i % 365 + 1).cast("int").alias("DayOfYear"),
        F.when(i % 3 == 0, "ZZ").otherwise("AA").alias("Carrier"),
        airport.alias("Origin"),
        F.concat(F.lit("B"), i % 3).alias("Dest"),
        (i % 90).cast("string").alias("FlightNum"),
    )


@pytest.fixture(scope="module")
def fitted(features):
    return model.train(features, numTrees=5)


def requests(spark, *rows):
    cols = "UUID string, Carrier string, Origin string, Dest string, DepDelay double, Distance double"
    return spark.createDataFrame(rows, cols).select(
        "*",
        F.lit(3).alias("DayOfMonth"), F.lit(6).alias("DayOfWeek"), F.lit(40).alias("DayOfYear"),
        F.lit("2024-02-09").cast("date").alias("FlightDate"),
        F.expr("TIMESTAMP'2024-02-09T10:00:00Z'").alias("Timestamp"),
    )


def test_class_edges(spark):
    delays = [-15.1, -15.0, -0.1, 0.0, 29.9, 30.0, None]
    df = spark.createDataFrame([(d,) for d in delays], "ArrDelay double")
    got = [r["ArrDelayBucket"] for r in model.delay_bucket(df).collect()]
    assert got == [0, 1, 1, 2, 2, 3, None]


def test_indexes_go_by_frequency_then_name(features):
    labels = model.index_columns(feat.with_route(features)).labelsArray
    assert list(labels[0]) == ["AA", "ZZ"]
    assert list(labels[1]) == [f"A{i}" for i in range(5)]


def test_vector_holds_nine_numbers_in_order(features, fitted):
    rows = model.training_rows(features)
    indexed = model.index_columns(rows).transform(rows)
    row = model.assemble(indexed).first()
    want = [row[c] for c in model.VECTOR_COLUMNS]
    assert list(row[model.VECTOR].toArray()) == want


def test_forest_learns_and_predicts_all_classes(features, fitted):
    scored = model.score(model.delay_bucket(features), fitted)
    assert model.accuracy(scored) > 0.8
    assert model.accuracy_table(scored).first()[0] == pytest.approx(model.accuracy(scored))
    assert scored.select("Prediction").distinct().count() >= 3


def test_bins_cover_the_widest_column():
    assert model.bins_for([["a"] * 3]) == 32
    assert model.bins_for([["a"] * 40, ["b"]]) == 41


def test_unseen_and_missing_values_pass_only_when_serving(spark, fitted):
    rows = requests(
        spark, ("u", "NEW", "A1", "B1", 5.0, 1.0), ("v", None, "A1", "B1", 5.0, 1.0),
        ("w", "AA", "A1", "B1", None, None),
    )
    with pytest.raises(Exception, match="handleInvalid"):
        model.score(rows, model.for_serving(fitted, "error")).collect()
    scored = model.score(rows, model.for_serving(fitted)).collect()
    assert len(scored) == 3 and all(r["Prediction"] in (0, 1, 2, 3) for r in scored)


def test_scores_keep_the_request_and_drop_helpers(spark, fitted):
    rows = requests(spark, ("u", "AA", "A1", "B1", 50.0, 1.0))
    scored = model.score(rows, model.for_serving(fitted))
    assert set(scored.columns) == {*rows.columns, "Prediction"}
    with_route = model.score(rows, model.for_serving(fitted), keep_route=True)
    assert with_route.first()["Route"] == "A1-B1"


def test_aligned_weekday_is_for_the_model_only(spark, fitted):
    rows = requests(spark, ("u", "AA", "A1", "B1", 50.0, 1.0))
    scored = model.score(rows, model.for_serving(fitted), align_dow=True)
    assert scored.first()["DayOfWeek"] == 6
    assert set(scored.columns) == {*rows.columns, "Prediction"}


def test_saved_model_predicts_the_same(spark, fitted, tmp_path):
    rows = requests(spark, *[(str(i), "AA", "A1", "B1", float(i), 1.0) for i in range(-30, 60, 7)])
    for _ in range(2):
        model.save_model(fitted, str(tmp_path / "model"))
    again = model.for_serving(model.load_model(str(tmp_path / "model")))
    assert model.score(rows, again).collect() == model.score(rows, model.for_serving(fitted)).collect()
    model.save_bucketizer(str(tmp_path / "classes"))
    assert model.load_bucketizer(str(tmp_path / "classes")).getSplits() == model.DELAY_SPLITS


def test_training_is_repeatable(features, fitted):
    again = model.train(features, numTrees=5)
    a, b = fitted.stages[-1], again.stages[-1]
    assert a.toDebugString.split("\n")[1:] == b.toDebugString.split("\n")[1:]


def test_batch_and_message_scoring_agree(spark, fitted):
    rows = requests(
        spark, *[(str(i), "AA", f"A{i % 5}", "B1", float(i), None) for i in range(-30, 60, 5)]
    )
    known = spark.createDataFrame([(f"A{i}", "B1", 100.0 * i) for i in range(4)], DISTANCES)
    sent = rows.select(to_message().alias("value"))
    by_message = scoring.score_stream(sent, known, fitted)
    assert by_message.columns == SCORED.fieldNames()
    batch = model.score(
        rows.drop("Distance").join(known, ["Origin", "Dest"], "left").na.fill({"Distance": 0.0}),
        model.for_serving(fitted),
    )
    key = lambda df: sorted((r["UUID"], r["Distance"], r["Prediction"]) for r in df.collect())
    assert key(by_message) == key(batch)
    aligned = scoring.score_stream(sent, known, fitted, align_dow=True)
    assert aligned.columns == SCORED.fieldNames() and aligned.first()["DayOfWeek"] == 6


def test_minutes(spark, features):
    fitted = model.train_regressor(features, numTrees=3)
    rows = requests(spark, ("u", "AA", "A1", "B1", 5.0, 1.0)).withColumn("FlightNum", F.lit("7"))
    scored = model.score_minutes(rows, fitted)
    assert set(scored.columns) == {*rows.columns, "Delay"}
    assert -25 < scored.first()["Delay"] < 60


def test_rows_are_spread_before_training(spark):
    rows = spark.range(0, 1000, 1, 1).toDF("x")
    parts = model.spread(rows, 50)
    counts = [r["n"] for r in parts.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(counts) >= 20 and max(counts) <= 100 and sum(counts) == 1000
    assert model.spread(rows, 1000) is rows


@pytest.mark.parametrize("train", [model.train, model.train_regressor])
def test_a_forest_reads_the_rows_it_fits_once_beside_the_indexes(spark, train):
    def rows_read():
        seen = spark.sparkContext.accumulator(0)

        def count(parts):
            for part in parts:
                seen.add(part.num_rows)
                yield part

        days = spark.range(400).selectExpr(
            "concat('C', id % 3) AS Carrier", "concat('A', id % 5) AS Origin", "concat('A', id % 4) AS Dest",
            "cast(id % 9 as string) AS FlightNum", "cast(id % 31 + 1 as int) AS DayOfMonth", "cast(id % 7 + 1 as int) AS DayOfWeek",
            "cast(id % 365 + 1 as int) AS DayOfYear", "cast(id % 50 as double) AS Distance", "cast(id % 40 as double) AS DepDelay",
            "cast(id % 45 - 20 as double) AS ArrDelay",
        )
        return days.mapInArrow(count, days.schema), seen

    rows, seen = rows_read()
    fitted = train(rows, numTrees=2, maxDepth=2)
    # Counted, indexed and assembled: three reads, whatever the forest's depth.
    assert 400 <= seen.value <= 1200
    assert fitted.transform(feat.with_route(rows)).count() == 400
