"""Batch writers."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylag.functions.messages import keyed_messages, to_message
from skylag.session import local_path, ship
from skylag.sinks import bzip2
from skylag.sources.topics import BROKER


def write_json(
    df: DataFrame, path: str, files: int | None = None, compression: str | None = None
) -> None:
    """Replace ``path`` by JSON lines.

    Every task writes its own file. ``files`` merges them for a reader that
    wants few, which is for small results only: it also limits the writers.
    bzip2 files that Python can reach are packed there, others by Hadoop's codec.
    """
    out = df.coalesce(files) if files else df
    folder = local_path(df.sparkSession, path) if compression == "bzip2" else None
    if folder:
        ship(df.sparkSession)
        df.sparkSession.dataSource.register(bzip2.Bzip2Lines)
        lines = out.select(F.to_json(F.struct("*")).alias("value"))
        lines.write.format(bzip2.FORMAT).mode("overwrite").option("suffix", ".json.bz2").save(folder)
        return
    writer = out.write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    writer.json(path)


def day_path(path: str, day: str) -> str:
    return f"{path}/request_date={day}"


def write_daily(df: DataFrame, path: str, day: str) -> None:
    """Replace one day's folder as JSON lines, also when the day is empty."""
    df.write.mode("overwrite").json(day_path(path, day))


def write_days(df: DataFrame, path: str, date: str | Column) -> None:
    """Replace the folders of all days that occur in ``df``; other days stay.

    Rows are balanced by day first: small days are not scattered over the files
    of all tasks, and a busy day is split over several.
    """
    dated = df.withColumn("request_date", F.col(date) if isinstance(date, str) else date)
    (
        dated.hint("rebalance", F.col("request_date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("request_date")
        .json(path)
    )


def append_collection(df: DataFrame, name: str, fmt: str = "parquet", **options: str) -> None:
    """Append documents to a collection: a path for file formats, else a name."""
    writer = df.write.mode("append").format(fmt).options(**options)
    if fmt in ("parquet", "json", "orc"):
        writer.save(name)
    else:
        writer.option("collection", name).save()


def write_clustered(
    df: DataFrame, path: str, keys: Sequence[str], files: int | None = None
) -> None:
    """Replace ``path`` by files that hold neighbouring keys, sorted, so that a
    lookup reads only the files whose key range fits."""
    ranges = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    ranges.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def write_version(df: DataFrame, path: str, keys: Sequence[str], pointer: str = "current") -> str:
    """Write a new version of a clustered table, then switch the pointer to it.

    Versions before it stay as they are, so a reader that has one open goes on
    reading it; a crash before the switch leaves the old version current. Remove old
    versions once nothing reads them.
    """
    version = f"version={uuid.uuid4().hex}"
    write_clustered(df, f"{path}/{version}", keys)
    named = df.sparkSession.createDataFrame([(version,)], "value string").coalesce(1)
    named.write.mode("overwrite").text(f"{path}/{pointer}")
    return f"{path}/{version}"


def topic_rows(df: DataFrame, topic: str, key: str | None = "UUID", at: Column | None = None) -> DataFrame:
    """Rows as messages of a topic. ``key=None`` sends messages without key."""
    if key:
        messages = keyed_messages(df, key)
    else:
        messages = df.select(F.lit(None).cast("string").alias("key"), to_message().alias("value"))
    stamp = F.current_timestamp() if at is None else at
    return messages.select("key", "value", F.lit(topic).alias("topic"), stamp.alias("timestamp"))


def write_topic(
    messages: DataFrame, topic: str, fmt: str = "parquet", servers: str = "localhost:9092"
) -> None:
    """Send message rows to a broker's topic, or append them to a folder."""
    if fmt == BROKER:
        sent = messages.select("key", "value").write.format(fmt)
        sent.option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    else:
        messages.write.mode("append").format(fmt).save(topic)


def emit_requests(
    df: DataFrame, topic: str, fmt: str = "parquet", servers: str = "localhost:9092"
) -> None:
    """Send each request as one JSON message. Requests have no message key."""
    name = topic.rstrip("/").rsplit("/", 1)[-1]
    write_topic(topic_rows(df, name, key=None), topic, fmt, servers)
