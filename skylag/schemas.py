"""Schemas of the files, messages and tables the jobs exchange."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


S, I, D = T.StringType(), T.IntegerType(), T.DoubleType()

# Field names, types and order of files and messages.

# Training features. Schedule times carry no zone, so the session zone never
# moves a flight to another day.
FEATURES = _struct(
    ("ArrDelay", D),
    ("CRSArrTime", T.TimestampNTZType()),
    ("CRSDepTime", T.TimestampNTZType()),
    ("Carrier", S),
    ("DayOfMonth", I),
    ("DayOfWeek", I),
    ("DayOfYear", I),
    ("DepDelay", D),
    ("Dest", S),
    ("Distance", D),
    ("FlightDate", T.DateType()),
    ("FlightNum", S),
    ("Origin", S),
)

# One request of the daily batch.
BATCH_REQUEST = _struct(
    ("Carrier", S),
    ("DayOfMonth", I),
    ("DayOfWeek", I),
    ("DayOfYear", I),
    ("DepDelay", D),
    ("Dest", S),
    ("Distance", D),
    ("FlightDate", T.DateType()),
    ("FlightNum", S),
    ("Origin", S),
    ("Timestamp", T.TimestampType()),
)

# One scored request of the daily batch, as stored: dates and times stay text.
BATCH_RESULT = T.StructType(
    [
        T.StructField(f.name, S if f.name in ("FlightDate", "Timestamp") else f.dataType, True)
        for f in BATCH_REQUEST.fields
    ]
    + [T.StructField("Route", S, True), T.StructField("Prediction", D, True)]
)

# One request message of the continuous job.
STREAM_REQUEST = _struct(
    ("Origin", S),
    ("FlightNum", S),
    ("DayOfWeek", I),
    ("DayOfYear", I),
    ("DayOfMonth", I),
    ("Dest", S),
    ("DepDelay", D),
    ("Prediction", S),
    ("Timestamp", T.TimestampType()),
    ("FlightDate", T.DateType()),
    ("Carrier", S),
    ("UUID", S),
    ("Distance", D),
    ("Carrier_index", D),
    ("Origin_index", D),
    ("Dest_index", D),
    ("Route_index", D),
)

# Columns kept when a request message is flattened, in order.
REQUEST_COLUMNS = [
    "Origin", "DayOfWeek", "DayOfYear", "DayOfMonth", "Dest",
    "DepDelay", "Timestamp", "FlightDate", "Carrier", "UUID",
]

# One scored message.
SCORED = _struct(
    ("Origin", S),
    ("DayOfWeek", I),
    ("DayOfYear", I),
    ("DayOfMonth", I),
    ("Dest", S),
    ("DepDelay", D),
    ("Timestamp", T.TimestampType()),
    ("FlightDate", T.DateType()),
    ("Carrier", S),
    ("UUID", S),
    ("Distance", D),
    ("Prediction", D),
)

DISTANCES = _struct(("Origin", S), ("Dest", S), ("Distance", D))

# A topic kept in files: the columns a message broker gives, so that the same
# code reads either.
TOPIC = _struct(
    ("key", S),
    ("value", S),
    ("topic", S),
    ("timestamp", T.TimestampType()),
)

# Categorical columns to index, in the order of the feature vector.
INDEXED = ["Carrier", "Origin", "Dest", "Route"]
NUMERIC = ["DepDelay", "Distance", "DayOfMonth", "DayOfWeek", "DayOfYear"]
INDEX_COLUMNS = [f"{name}_index" for name in INDEXED]
VECTOR_COLUMNS = NUMERIC + INDEX_COLUMNS
