"""Delay classes, feature vectors, and the models that predict delays."""

from __future__ import annotations

from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    Bucketizer,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from skylag.operators.features import with_route
from skylag.schemas import INDEX_COLUMNS, INDEXED, VECTOR_COLUMNS

# The edges of the delay classes (early, slightly early, slightly
# late, very late), closed on the left.
DELAY_SPLITS = [-float("inf"), -15.0, 0.0, 30.0, float("inf")]
LABEL = "ArrDelayBucket"
VECTOR = "Features_vec"
# Fixed value: bins for the widest categorical column of the full data.
MAX_BINS = 4657

MODEL_INPUTS = [
    "Origin", "DayOfWeek", "DayOfYear", "DayOfMonth", "Dest", "DepDelay", "Timestamp",
    "FlightDate", "Carrier", "UUID", "Distance", *INDEX_COLUMNS,
]

# Rows a task trains on, at most: a forest holds each with a count for every tree.
ROWS_A_PART = 1_000_000

# What indexing, assembling and the forest put beside a request.
HELPERS = [*INDEX_COLUMNS, VECTOR, "rawPrediction", "probability"]


def delay_bucketizer() -> Bucketizer:
    return Bucketizer(splits=DELAY_SPLITS, inputCol="ArrDelay", outputCol=LABEL)


def delay_bucket(df: DataFrame) -> DataFrame:
    """``ArrDelayBucket`` 0 to 3; an unknown delay has no class."""
    return delay_bucketizer().transform(df)


def indexer(handle_invalid: str = "error") -> StringIndexer:
    """Indexes by falling frequency, ties by name."""
    return StringIndexer(
        inputCols=INDEXED, outputCols=INDEX_COLUMNS, handleInvalid=handle_invalid
    )


def index_columns(df: DataFrame, handle_invalid: str = "error") -> StringIndexerModel:
    """Fit all four indexes in one job. Labels live on the driver, so these are
    columns of codes (carriers, airports, routes), never free text."""
    return indexer(handle_invalid).fit(df)


def assembler(handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(
        inputCols=VECTOR_COLUMNS, outputCol=VECTOR, handleInvalid=handle_invalid
    )


def assemble(df: DataFrame, handle_invalid: str = "error") -> DataFrame:
    return assembler(handle_invalid).transform(df)


def training_rows(features: DataFrame) -> DataFrame:
    """Features with route and class, only the columns training reads."""
    rows = delay_bucket(with_route(features))
    used = [c for c in VECTOR_COLUMNS if c not in INDEX_COLUMNS]
    return rows.select(*used, *INDEXED, LABEL)


def bins_for(labels: list[list[str]]) -> int:
    """Bins a forest needs so that each category has one, and one for unseen."""
    return max(32, max(len(found) for found in labels) + 1)


def spread(rows: DataFrame, at_most: int = ROWS_A_PART) -> DataFrame:
    """The rows in even parts of ``at_most`` rows, where they are more than one part. What
    columnar files pack into one read is many times as large once it is held for training."""
    parts = -(-rows.count() // at_most)
    if parts <= 1:
        return rows
    return rows.repartition(max(parts, rows.sparkSession.sparkContext.defaultParallelism))


def fit_forest(rows: DataFrame, prepared: list[Transformer], forest: Estimator) -> PipelineModel:
    """The pipeline of fitted stages and the forest fitted behind them.

    A forest reads its rows to count, to find splits and to hold them. They are dealt,
    indexed and assembled once and lie on the disks of the executors meanwhile.
    """
    ready = PipelineModel(prepared).transform(rows).select(forest.getFeaturesCol(), forest.getLabelCol())
    ready.persist(StorageLevel.DISK_ONLY)
    try:
        return PipelineModel([*prepared, forest.fit(ready)])
    finally:
        ready.unpersist()


def train(
    features: DataFrame,
    max_bins: int = MAX_BINS,
    max_memory_mb: int = 1024,
    seed: int = 42,
    **forest: int,
) -> PipelineModel:
    """Fit indexes, vector and forest. Pass features read from a written table:
    fitting reads them several times.

    ``max_bins`` is raised to what the widest column needs; the default is the value
    for the full flight data, in jobs and queries alike.
    """
    rows = training_rows(features)
    indexes = index_columns(rows)
    forest_stage = RandomForestClassifier(
        featuresCol=VECTOR,
        labelCol=LABEL,
        predictionCol="Prediction",
        maxBins=max(max_bins, bins_for(indexes.labelsArray)),
        maxMemoryInMB=max_memory_mb,
        seed=seed,
        **forest,
    )
    return fit_forest(spread(rows), [indexes, assembler()], forest_stage)


def for_serving(model: PipelineModel, handle_invalid: str = "keep") -> PipelineModel:
    """A copy whose stages let unseen and missing values through."""
    ready = model.copy()
    for stage in ready.stages:
        if isinstance(stage, (StringIndexerModel, VectorAssembler)):
            stage.setHandleInvalid(handle_invalid)
    return ready


def save_model(model: PipelineModel, path: str) -> None:
    """Save all fitted stages, each in its own folder below ``path``, replacing
    what is there."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_bucketizer(path: str) -> None:
    delay_bucketizer().write().overwrite().save(path)


def load_bucketizer(path: str) -> Bucketizer:
    return Bucketizer.load(path)


def select_model_inputs(indexed: DataFrame) -> DataFrame:
    """Indexed requests in their final columns and order, without the route."""
    return indexed.select(*MODEL_INPUTS)


def drop_helpers(df: DataFrame) -> DataFrame:
    """Without index, vector and score columns; names that are absent do not matter."""
    return df.drop(*HELPERS)


def score(
    df: DataFrame, model: PipelineModel, align_dow: bool = False, keep_route: bool = False
) -> DataFrame:
    """Requests with ``Prediction``, otherwise as they came.

    Requests count weekdays from Monday = 0 and training data from 1. With
    ``align_dow`` the weekday is moved to the training scale for the model only.
    """
    rows = with_route(df)
    if align_dow:
        rows = rows.withColumns(
            {"_dow": F.col("DayOfWeek"), "DayOfWeek": F.col("DayOfWeek") + 1}
        )
    scored = drop_helpers(model.transform(rows))
    if align_dow:
        scored = scored.withColumn("DayOfWeek", F.col("_dow")).drop("_dow")
    return scored if keep_route else scored.drop("Route")


def accuracy(df: DataFrame) -> float:
    """The share of rows whose prediction equals their class."""
    evaluator = MulticlassClassificationEvaluator(
        predictionCol="Prediction", labelCol=LABEL, metricName="accuracy"
    )
    return evaluator.evaluate(df)


def accuracy_table(df: DataFrame) -> DataFrame:
    """The same as a one-row table, for use inside a larger query."""
    return df.agg(F.avg((F.col("Prediction") == F.col(LABEL)).cast("double")).alias("accuracy"))


# Minutes of delay instead of classes.

REGRESSION_INDEXED = ["Origin", "Dest", "FlightNum"]
REGRESSION_NUMERIC = ["Distance", "DayOfYear", "DayOfMonth", "DayOfWeek"]


def train_regressor(
    features: DataFrame, seed: int = 42, **forest: int
) -> PipelineModel:
    """A forest that predicts the arrival delay in minutes from route, flight
    number, distance and date. The departure delay is not among its inputs.

    Flight numbers have at most four digits; each is a category of its own.
    """
    names = [f"{c}_index" for c in REGRESSION_INDEXED]
    rows = features.select(
        *REGRESSION_INDEXED, *REGRESSION_NUMERIC, "ArrDelay"
    ).where(F.col("ArrDelay").isNotNull())
    indexes = StringIndexer(
        inputCols=REGRESSION_INDEXED, outputCols=names, handleInvalid="keep"
    ).fit(rows)
    vector = VectorAssembler(
        inputCols=[*names, *REGRESSION_NUMERIC],
        outputCol=VECTOR,
        handleInvalid="keep",
    )
    forest_stage = RandomForestRegressor(
        featuresCol=VECTOR,
        labelCol="ArrDelay",
        predictionCol="Delay",
        maxBins=bins_for(indexes.labelsArray),
        seed=seed,
        **forest,
    )
    return fit_forest(rows, [indexes, vector], forest_stage)


def score_minutes(df: DataFrame, model: PipelineModel, align_dow: bool = False) -> DataFrame:
    """Requests with ``Delay`` in minutes. ``align_dow`` as in ``score``."""
    helpers = [f"{c}_index" for c in REGRESSION_INDEXED]
    rows = df
    if align_dow:
        rows = df.withColumns({"_dow": F.col("DayOfWeek"), "DayOfWeek": F.col("DayOfWeek") + 1})
    scored = model.transform(rows).drop(*helpers, VECTOR)
    return scored.withColumn("DayOfWeek", F.col("_dow")).drop("_dow") if align_dow else scored
