"""Readers. Every one returns a lazy DataFrame whose filters and column choice
reach the scan."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylag.functions.messages import JSON_OPTIONS
from skylag.schemas import BATCH_REQUEST, DISTANCES, FEATURES
from skylag.sinks import folders
from skylag.sinks.files import day_path


def read_flights(spark: SparkSession, path: str) -> DataFrame:
    """The columnar flights table; its footers hold the schema."""
    return spark.read.parquet(path)


def with_row_key(df: DataFrame) -> DataFrame:
    """A table read from Parquet with ``RowKey``, a hash of the file and position
    of each row. It tells copies apart and is the same in every attempt of a task."""
    return df.withColumn("RowKey", F.xxhash64("_metadata.file_path", "_metadata.row_index"))


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly over tasks. A file is read by as many tasks as it has row
    groups, at most; what follows the read would run on that few cores."""
    return df.hint("rebalance")


def register(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Give a table a name for SQL text and hand it back."""
    df.createOrReplaceTempView(name)
    return spark.table(name)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Training features from JSON lines. The file suffix names the codec.

    Times and dates may carry an offset, as other writers print them: the clock
    shown is kept, whatever zone it is in. So a date that a writer moved to another
    day by its own zone stays the day it shows.
    """
    timed = [f for f in FEATURES.fields if isinstance(f.dataType, (T.TimestampNTZType, T.DateType))]
    text = T.StructType([T.StructField(f.name, T.StringType()) if f in timed else f for f in FEATURES.fields])
    clock = {f.name: F.col(f.name).try_cast("timestamp_ntz").cast(f.dataType) for f in timed}
    return spark.read.schema(text).json(path).withColumns(clock)


def split_json_lines(
    spark: SparkSession, path: str, schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """(fields of the lines that decode, the others as ``value``).

    A line with no field of the schema is none that decodes. Folder columns such as
    ``request_date`` stay beside both. A path that is not there is an error.
    """
    lines = spark.read.text(path)
    beside = [c for c in lines.columns if c != "value"]
    full = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    document = F.from_json("value", full, {**JSON_OPTIONS, "columnNameOfCorruptRecord": "_bad"})
    decoded = lines.select(*beside, "value", F.inline(F.array(document)))
    empty = F.coalesce(*[F.col(f.name).cast("string") for f in schema.fields]).isNull()
    bad = F.col("_bad").isNotNull() | empty
    return decoded.where(~bad).drop("value", "_bad"), decoded.where(bad).select(*beside, "value")


def read_requests(
    spark: SparkSession, path: str, day: str, schema: T.StructType = BATCH_REQUEST
) -> DataFrame:
    """One day of requests. Only that day's folder is listed and read; a day that was
    never fetched is an error, and lines that do not decode are left to
    ``read_request_rejects``."""
    return split_json_lines(spark, day_path(path, day), schema)[0]


def read_request_rejects(
    spark: SparkSession, path: str, day: str, schema: T.StructType = BATCH_REQUEST
) -> DataFrame:
    """The lines of one day of requests that do not decode, as ``value``."""
    return split_json_lines(spark, day_path(path, day), schema)[1]


def read_json_text(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Text lines, each one JSON document, decoded to columns; others left out."""
    return split_json_lines(spark, path, schema)[0].select(*schema.fieldNames())


def read_collection(
    spark: SparkSession,
    name: str,
    fmt: str = "parquet",
    where: Column | None = None,
    **options: str,
) -> DataFrame:
    """A document collection, with the range query left to the store.

    ``name`` is a path for file formats and is passed as ``collection`` to any
    other format. The predicate is a plain filter: the source takes over what
    it can evaluate itself.
    """
    reader = spark.read.format(fmt).options(**options)
    if fmt in ("parquet", "json", "orc"):
        df = reader.load(name)
    else:
        df = reader.option("collection", name).load()
    return df.where(where) if where is not None else df


def distances_version(spark: SparkSession, path: str, fmt: str = "parquet") -> str | None:
    """The name of what ``path`` holds now, for ``read_distances``: a commit of a table in
    folders, a version folder, or None for a plain table."""
    if fmt != "parquet":
        return None
    numbers = folders.commits(spark, path)
    return str(numbers[-1]) if numbers else current_version(spark, path)


def read_distances(
    spark: SparkSession, path: str | None = None, fmt: str = "parquet", version: str | None = None, **options: str
) -> DataFrame:
    """The route distances, columns renamed to the names requests use.

    Pass ``keyspace`` and ``table`` as options for a wide-column store; stores
    that fold names to lower case resolve all the same. Of a table kept in folders or
    in versions the current state is read, or the one that ``version`` names.
    """
    if path and fmt == "parquet":
        version = version or distances_version(spark, path)
        if version and version.isdigit():
            return folders.read_folders(spark, path, DISTANCES, int(version))
        path = version or path
    reader = spark.read.format(fmt).options(**options)
    if fmt == "json":
        reader = reader.schema(DISTANCES)
    df = reader.load(path) if path else reader.load()
    return df.select(
        F.col("origin").alias("Origin"),
        F.col("dest").alias("Dest"),
        F.col("distance").alias("Distance"),
    )


CURRENT = "current"


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder of the version of a table that its pointer names; None without one."""
    pointer = f"{path}/{CURRENT}"
    try:
        names = spark.read.text(pointer).collect()  # one short line
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return f"{path}/{names[0].value}"
