"""One scoring of each micro-batch for several sinks, each of which gets it once."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skylag.session import get_text, names_in, put_text, remove
from skylag.sinks.files import append_collection, topic_rows, write_topic
from skylag.streaming.sinks import _start, batch_folder

Writer = Callable[[DataFrame, int], None]

_VERSION = "version"


class Ledger:
    """What is finished of the micro-batch in hand: empty files below ``path``, by query
    and batch. Spark repeats only the last batch of a query, so older ones go."""

    def __init__(self, spark: SparkSession, path: str, batch_id: int):
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        self.spark, self.query, self.batch = spark, f"{path}/query={query}", f"batch={batch_id}"
        for name in names_in(spark, self.query):
            if name != self.batch:
                remove(spark, f"{self.query}/{name}")
        self.done = set(names_in(spark, f"{self.query}/{self.batch}"))

    def mark(self, name: str, text: str = "") -> None:
        put_text(self.spark, f"{self.query}/{self.batch}/{name}", text)
        self.done.add(name)

    def version(self, resolve: Callable[[], str | None]) -> str | None:
        """The version the batch began with, or the current one if it begins now."""
        if _VERSION in self.done:
            return get_text(self.spark, f"{self.query}/{self.batch}/{_VERSION}") or None
        found = resolve()
        self.mark(_VERSION, found or "")
        return found


def deliver(
    messages: DataFrame,
    score: Callable[[DataFrame, str | None], DataFrame],
    writers: Mapping[str, Writer],
    checkpoint: str,
    ledger: str,
    version: Callable[[], str | None] = lambda: None,
    raw_writers: Mapping[str, Writer] | None = None,
    trigger: str | None = None,
) -> StreamingQuery:
    """Score each micro-batch once and hand it to every sink that does not have it yet.

    ``version`` names the state of what scoring looks up; it is asked once for each
    batch, so all rows of a batch see the same state, and a batch that is repeated
    sees the one it began with. A sink is marked in the ledger once its write has ended.
    If the job dies between the write and the mark, the sink gets the batch again:
    sinks that replace by ``batch_folder`` are not changed by that, readers of a topic
    leave doubles out with ``topics.once``. ``raw_writers`` get the messages.
    """
    names = [*writers, *(raw_writers or {})]
    if len(set(names)) < len(names) or _VERSION in names:
        raise ValueError(f"sinks need names of their own: {names}")

    def write(batch: DataFrame, batch_id: int) -> None:
        book = Ledger(batch.sparkSession, ledger, batch_id)
        state = book.version(version)
        open_raw = {n: w for n, w in (raw_writers or {}).items() if n not in book.done}
        source = batch.persist() if open_raw else batch
        scored = score(source, state).persist()
        try:
            for kept, sinks in ((scored, writers), (source, open_raw)):
                waiting = {name: writer for name, writer in sinks.items() if name not in book.done}
                empty = bool(waiting) and kept.isEmpty()
                for name, writer in waiting.items():
                    if not empty:
                        writer(kept, batch_id)
                    book.mark(name)
        finally:
            scored.unpersist()
            source.unpersist()

    return _start(messages.writeStream.foreachBatch(write), checkpoint, trigger)


def collection_writer(name: str, fmt: str = "parquet", **options: str) -> Writer:
    """Files by query and batch, which a repeat replaces; other stores are appended to."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if fmt in ("parquet", "json", "orc"):
            batch.write.mode("overwrite").format(fmt).options(**options).save(batch_folder(name, batch, batch_id))
        else:
            append_collection(batch, name, fmt, **options)

    return write


def topic_writer(topic: str, fmt: str = "parquet", servers: str = "localhost:9092", key: str = "UUID") -> Writer:
    """The id as key, all columns as JSON."""
    name = topic.rstrip("/").rsplit("/", 1)[-1]
    return lambda batch, _: write_topic(topic_rows(batch, name, key), topic, fmt, servers)


def console_writer(rows: int = 20) -> Writer:
    def write(batch: DataFrame, batch_id: int) -> None:
        print(f"-- batch {batch_id}")
        batch.limit(rows).show(rows, truncate=False)

    return write


def once(messages: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """A topic's messages with each key once: of a stream, keys seen again within
    ``lateness`` are left out and older ones forgotten; of a table the earliest message
    of a key stays. Messages without key stay as they are."""
    keyed, others = messages.where("key is not null"), messages.where("key is null")
    if messages.isStreaming:
        seen = keyed.withWatermark("timestamp", lateness).dropDuplicatesWithinWatermark(["key"])
        return seen.union(others.withWatermark("timestamp", lateness))
    rest = F.struct("timestamp", *[c for c in messages.columns if c not in ("key", "timestamp")])
    first = keyed.groupBy("key").agg(F.min(rest).alias("m"))
    return first.select("key", "m.*").select(*messages.columns).union(others)
