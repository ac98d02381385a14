"""JSON messages: encode, decode, and keep the unreadable ones apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylag.schemas import REQUEST_COLUMNS, STREAM_REQUEST

# Message times are written and read in one zone, whatever the session uses.
JSON_OPTIONS = {"timeZone": "UTC"}


def to_message(*columns: str | Column) -> Column:
    """Columns to JSON text. NULL fields are left out; times keep milliseconds."""
    return F.to_json(F.struct(*(columns or ("*",))), JSON_OPTIONS)


def from_message(value: Column | str, schema: T.StructType) -> Column:
    """Binary or text message to a struct; all fields NULL if it is not JSON."""
    c = F.col(value) if isinstance(value, str) else value
    return F.from_json(c.cast("string"), schema, JSON_OPTIONS)


def decode_text(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """One JSON document per row of ``value`` to columns; unknown fields are ignored."""
    return df.select(from_message(value, schema).alias("doc")).select("doc.*")


def keyed_messages(df: DataFrame, key: str = "UUID") -> DataFrame:
    """Rows to topic messages: the key column as text, all columns as JSON."""
    return df.select(F.col(key).cast("string").alias("key"), to_message().alias("value"))


def decode_messages(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """``value`` as text, with the fields of its document beside it.

    ``inline`` keeps the decoding in a step of its own. As a plain column it
    would be copied into every filter on a decoded field and run once more there.
    """
    text = messages.select(F.col("value").cast("string").alias("value"))
    return text.select("value", F.inline(F.array(from_message("value", schema))))


def split_malformed(
    messages: DataFrame, schema: T.StructType = STREAM_REQUEST, key: str = "UUID"
) -> tuple[DataFrame, DataFrame]:
    """(fields of readable messages, text of all others).

    A message is readable when it decodes and names its key.
    """
    decoded = decode_messages(messages, schema)
    good = decoded.where(F.col(key).isNotNull()).drop("value")
    bad = decoded.where(F.col(key).isNull()).select("value")
    return good, bad


def flatten_request(decoded: DataFrame) -> DataFrame:
    """The ten base columns of decoded requests. The request's own distance is
    left behind: the distance table has the last word."""
    return decoded.select(*REQUEST_COLUMNS)


def parse_requests(messages: DataFrame) -> DataFrame:
    """Request messages to base columns, unreadable messages left out."""
    kept = T.StructType([STREAM_REQUEST[name] for name in REQUEST_COLUMNS])
    good, _ = split_malformed(messages, kept)
    return flatten_request(good)
