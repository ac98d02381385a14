"""The summary tables kept current while flights arrive."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from skylag.sinks.folders import BUCKETS, upsert_table
from skylag.streaming.sinks import _start


def keep_summary(
    flights: DataFrame,
    summarise: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    path: str,
    checkpoint: str,
    buckets: int = BUCKETS,
    trigger: str | None = None,
) -> StreamingQuery:
    """Keep ``summarise(flights)``, an aggregate by ``keys``, as a table in folders.

    State holds the running aggregate; a micro-batch gives the new rows of the keys it
    changed, and only their folders are written. Rows replace those of their key, so
    a batch that is repeated changes nothing; a batch holds each key once. Read the table with ``read_folders``.
    The state grows with the keys: use it for summaries, not for single flights.
    """
    summary = summarise(flights)
    schema = summary.schema

    def put(batch: DataFrame, batch_id: int) -> None:
        upsert_table(batch, path, schema, keys, buckets=buckets, once=True)

    return _start(summary.writeStream.outputMode("update").foreachBatch(put), checkpoint, trigger)
