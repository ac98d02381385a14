"""Topics: a message broker, or a folder of message files with the same columns."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skylag.schemas import TOPIC
from skylag.session import get_text, names_in, put_text, remove

BROKER = "kafka"


def broker_options(topic: str, servers: str, offsets: str | None = None) -> dict[str, str]:
    """Options for reading one topic of a broker."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if offsets:
        options["startingOffsets"] = offsets
    return options


def stream_topic(
    spark: SparkSession,
    topic: str,
    fmt: str = "parquet",
    servers: str = "localhost:9092",
    files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Unbounded (key, value, topic, timestamp) rows of a topic.

    A broker is read from its latest offset, the default of the source. A
    file-backed topic is a folder: ``topic`` is its path, and
    ``files_per_trigger`` bounds a micro-batch; ``options`` go to the source, such as
    ``maxOffsetsPerTrigger`` or ``minPartitions`` of a broker.
    """
    if fmt == BROKER:
        raw = spark.readStream.format(fmt).options(**broker_options(topic, servers), **options).load()
        return _message_columns(raw)
    reader = spark.readStream.schema(TOPIC).format(fmt).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return _message_columns(reader.load(topic))


def read_topic(
    spark: SparkSession, topic: str, fmt: str = "parquet", servers: str = "localhost:9092"
) -> DataFrame:
    """All messages of a topic from its beginning, as a bounded table."""
    if fmt == BROKER:
        options = broker_options(topic, servers, offsets="earliest")
        return _message_columns(spark.read.format(fmt).options(**options).load())
    return _message_columns(spark.read.schema(TOPIC).format(fmt).load(topic))


def read_new(
    spark: SparkSession, topic: str, offsets: str, fmt: str = "parquet", servers: str = "localhost:9092"
) -> tuple[DataFrame, Callable[[], None]]:
    """Messages of a topic since the last call that was finished, and what finishes it.

    Call the function once the messages are stored: it keeps where they end in the
    folder ``offsets``, and the next read begins there. Without it the next read gives
    the same messages again and those that came since. What arrives while the messages
    are read belongs to the next read: its end is fixed first.

    A broker's end is one offset a partition. A file-backed topic has no offsets; its
    files do not change, so its end is the files read, kept as a table and taken out by
    a join, and no list of them reaches the driver.
    """
    if fmt == BROKER:
        return _new_of_broker(spark, topic, offsets, servers)
    done = StructType.fromDDL("file string")
    kept = [f"{offsets}/{name}" for name in names_in(spark, offsets) if name.startswith("read=")]
    before = spark.read.schema(done).parquet(*kept) if kept else spark.createDataFrame([], done)
    stored = spark.read.schema(TOPIC).format(fmt).load(topic).withColumn("file", F.col("_metadata.file_path"))
    path = f"{offsets}/open={uuid.uuid4().hex}"
    # Files without messages hold nothing to read and stay out of the list.
    stored.select("file").distinct().join(before, "file", "left_anti").write.parquet(path)
    fresh = spark.read.schema(done).parquet(path)
    messages = _message_columns(stored.join(fresh, "file", "left_semi"))

    def finish() -> None:
        fresh.write.parquet(f"{offsets}/read={len(kept):08d}")
        remove(spark, path)

    return messages, finish


def _new_of_broker(spark: SparkSession, topic: str, offsets: str, servers: str) -> tuple[DataFrame, Callable[[], None]]:
    numbers = names_in(spark, offsets)
    start = get_text(spark, f"{offsets}/{numbers[-1]}") if numbers else "earliest"
    options = broker_options(topic, servers, offsets=start)
    ends = spark.read.format(BROKER).options(**options).load().groupBy("partition").agg(F.max("offset").alias("last"))
    # One row a partition.
    after = (json.loads(start)[topic] if numbers else {}) | {str(r.partition): r.last + 1 for r in ends.collect()}
    end = json.dumps({topic: after})
    messages = spark.read.format(BROKER).options(**options, endingOffsets=end if after else "latest").load()
    return _message_columns(messages), lambda: put_text(spark, f"{offsets}/{len(numbers):08d}", end)


def _message_columns(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "timestamp",
    )
