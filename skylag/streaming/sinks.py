"""Stream writers, each with a checkpoint folder of its own."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql import functions as F

from skylag.functions.messages import keyed_messages
from skylag.sources.topics import BROKER, stream_topic

# Fixed value: the period of the micro-batch jobs.
PERIOD = "10 seconds"


def _start(writer: DataStreamWriter, checkpoint: str | None, trigger: str | None) -> StreamingQuery:
    """Start with a period ("10 seconds"), "available" to drain and stop, or the
    default of one batch after another."""
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if trigger == "available":
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def sink_collection(
    df: DataFrame, name: str, checkpoint: str, fmt: str = "parquet",
    trigger: str | None = None, **options: str,
) -> StreamingQuery:
    """Append scored rows to a document collection."""
    writer = df.writeStream.outputMode("append").format(fmt).options(**options)
    writer = writer.option("path" if fmt in ("parquet", "json", "orc") else "collection", name)
    return _start(writer, checkpoint, trigger)


def sink_topic(
    df: DataFrame, topic: str, checkpoint: str, fmt: str = "parquet",
    servers: str = "localhost:9092", trigger: str | None = None, key: str = "UUID",
) -> StreamingQuery:
    """Append scored rows to a topic: the id as key, all columns as JSON."""
    messages = keyed_messages(df, key)
    if fmt == BROKER:
        writer = messages.writeStream.format(fmt).option("kafka.bootstrap.servers", servers)
        writer = writer.option("topic", topic)
    else:
        name = topic.rstrip("/").rsplit("/", 1)[-1]
        stamped = messages.select(
            "key", "value", F.lit(name).alias("topic"), F.current_timestamp().alias("timestamp")
        )
        writer = stamped.writeStream.format(fmt).option("path", topic)
    return _start(writer.outputMode("append"), checkpoint, trigger)


def sink_parquet(
    df: DataFrame, path: str, checkpoint: str, trigger: str | None = None
) -> StreamingQuery:
    writer = df.writeStream.outputMode("append").format("parquet").option("path", path)
    return _start(writer, checkpoint, trigger)


def sink_console(
    df: DataFrame, trigger: str | None = None, rows: int = 20, checkpoint: str | None = None
) -> StreamingQuery:
    """Print the first ``rows`` rows of each micro-batch; no more reach the driver.
    For looking at a stream, not for keeping it."""

    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"-- batch {batch_id}")
        batch.limit(rows).show(rows, truncate=False)

    return _start(df.writeStream.outputMode("append").foreachBatch(show), checkpoint, trigger)


def archive_topic(
    spark: SparkSession, topic: str, path: str, checkpoint: str, fmt: str = "parquet",
    servers: str = "localhost:9092", trigger: str | None = PERIOD,
) -> StreamingQuery:
    """Copy the messages of a topic to text files, one JSON object {"value": ...} a line.

    A message with line breaks stays one line, and one without a value is a line
    without the field. ``read_archive`` gives the messages back as they were.
    """
    values = stream_topic(spark, topic, fmt, servers).select(
        F.to_json(F.struct(F.col("value").cast("string").alias("value"))).alias("value")
    )
    writer = values.writeStream.outputMode("append").format("text").option("path", path)
    return _start(writer, checkpoint, trigger)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The messages of an archive: one column, ``value``."""
    lines = spark.read.text(path)
    return lines.select(F.from_json("value", "value string").alias("m")).select("m.value")


def start_sinks(
    df: DataFrame, sinks: Mapping[str, Callable[[DataFrame], StreamingQuery]]
) -> dict[str, StreamingQuery]:
    """One independent query for each sink. Each reads and scores for itself, so
    a slow or failing sink does not hold up the others; where scoring is the
    dear part, use ``fan_out``."""
    return {name: start(df) for name, start in sinks.items()}


def batch_folder(path: str, batch: DataFrame, batch_id: int) -> str:
    """Where one micro-batch of one query belongs. The query id is kept by the
    checkpoint, so a repeated batch replaces itself, and no other query's."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{path}/query={query}/batch={batch_id}"


def fan_out(
    df: DataFrame,
    writers: Mapping[str, Callable[[DataFrame, int], None]],
    checkpoint: str,
    trigger: str | None = None,
) -> StreamingQuery:
    """Score each micro-batch once and hand it to all writers.

    A batch may be repeated after a failure: writers must replace what the same
    batch wrote before, see ``batch_folder``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                for writer in writers.values():
                    writer(batch, batch_id)
        finally:
            batch.unpersist()

    return _start(df.writeStream.foreachBatch(write), checkpoint, trigger)


def each_batch(
    df: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str,
    trigger: str | None = PERIOD,
) -> StreamingQuery:
    """Call ``apply`` with every micro-batch that holds rows."""
    return fan_out(df, {"batch": apply}, checkpoint, trigger)


def run(spark: SparkSession) -> None:
    """Wait until any of the started queries ends or fails."""
    spark.streams.awaitAnyTermination()


def drain(*queries: StreamingQuery) -> None:
    """Wait for queries started with trigger "available"."""
    for query in queries:
        query.awaitTermination()
