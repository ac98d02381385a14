"""Scoring request messages as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from skylag.functions.messages import parse_requests
from skylag.operators.distances import with_distance
from skylag.operators.features import with_route
from skylag.operators.model import (
    drop_helpers,
    for_serving,
    score,
    select_model_inputs,
)
from skylag.schemas import SCORED
from skylag.sinks.files import append_collection
from skylag.streaming.sinks import batch_folder


def enrich_requests(messages: DataFrame, distances: DataFrame) -> DataFrame:
    """Messages to requests with route and the distance from the table."""
    return with_distance(with_route(parse_requests(messages)), distances, "zero")


def score_stream(
    messages: DataFrame, distances: DataFrame, model: PipelineModel, align_dow: bool = False
) -> DataFrame:
    """Messages to scored rows: parse, enrich, index, assemble, predict.

    The same plan serves a stream and a table. All stages are narrow except the
    distance lookup; pass distances read from a written table, whose size the
    planner knows. A table that changes while the stream runs is picked up by
    scoring in ``score_batch`` instead.
    """
    ready = for_serving(model)
    enriched = enrich_requests(messages, distances)
    if align_dow:
        return score(enriched, ready, align_dow=True).select(*SCORED.fieldNames())
    indexes, *rest = ready.stages
    inputs = select_model_inputs(indexes.transform(enriched))
    scored = drop_helpers(PipelineModel(rest).transform(inputs))
    return scored.select(*SCORED.fieldNames())


def score_batch(
    distances: Callable[[], DataFrame], model: PipelineModel, collection: str,
    fmt: str = "parquet", **options: str,
) -> Callable[[DataFrame, int], None]:
    """A micro-batch callback: score the batch and append it to a collection.

    ``distances`` is called for each batch, so updates of the table show.
    """
    files = fmt in ("parquet", "json", "orc")

    def apply(batch: DataFrame, batch_id: int) -> None:
        scored = score_stream(batch, distances(), model)
        if files:
            folder = batch_folder(collection, batch, batch_id)
            scored.write.mode("overwrite").format(fmt).save(folder)
        else:
            append_collection(scored, collection, fmt, **options)

    return apply
