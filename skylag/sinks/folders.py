"""Tables kept in folders, of which a write replaces only those it touches.

Each folder holds the rows of one value of a column: a hash of the keys, a day, a
year. A write puts new files for the folders it changes beside the old ones, then
commits a short list that names the files' place for every folder. Untouched
folders keep their files; a reader that has a list open goes on with it, and a
crash before the commit leaves the list before it current. Commits are numbered, so
any kept one can be read again; one writer at a time, a second one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skylag.operators.distances import upsert
from skylag.session import get_text, materialise, names_in, put_text, remove

BUCKETS = 64
BUCKET = "_bucket"


def commits(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the commits of a table, oldest first."""
    return [int(name) for name in names_in(spark, f"{path}/commits") if name.isdigit()]


def _listed(spark: SparkSession, path: str, commit: int | None = None) -> dict:
    """A commit, by default the last: its number, the folder column and the places."""
    numbers = commits(spark, path)
    if not numbers:
        return {"commit": 0, "column": None, "buckets": None, "places": {}}
    if commit is None:
        commit = numbers[-1]
    return {"commit": commit, **json.loads(get_text(spark, f"{path}/commits/{commit:012d}"))}


def _commit(spark: SparkSession, path: str, listed: dict) -> int:
    number = listed["commit"] + 1
    text = json.dumps({k: listed[k] for k in ("column", "buckets", "places")})
    put_text(spark, f"{path}/commits/{number:012d}", text)
    return number


def read_folders(
    spark: SparkSession, path: str, schema: StructType, commit: int | None = None, only: Iterable[str] | None = None
) -> DataFrame:
    """Rows of a table, of all folders or of those named in ``only``."""
    places = _listed(spark, path, commit)["places"]
    wanted = places if only is None else [value for value in map(str, only) if value in places]
    found = [f"{path}/{places[value]}" for value in wanted]
    # Places are given one by one, so their names make no columns.
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)


def replace_folders(
    rows: DataFrame, path: str, column: str, values: Iterable[str], order: Sequence[str] = (), buckets: int | None = None
) -> int:
    """Put ``rows`` in the place of the folders ``values``; the number of the commit.

    ``column`` gives the folder of each row, as a text that is not empty, and is not
    stored; rows of other folders are an error. A value without rows loses its folder. Give the values of one
    write, not of a table that grows: they are listed on the driver.
    """
    spark, wanted = rows.sparkSession, sorted({str(v) for v in values})
    listed = _listed(spark, path)
    if listed["column"] not in (None, column):
        raise ValueError(f"{path} is kept by {listed['column']}, not by {column}")
    write = f"write={uuid.uuid4().hex}"
    placed = rows.withColumn(column, F.col(column).cast("string"))
    inside = F.col(column).isin(wanted) if wanted else F.lit(False)
    checked = F.when(inside, F.col(column)).otherwise(
        F.raise_error(F.concat(F.lit("row outside the folders replaced: "), F.coalesce(column, F.lit("NULL")))).cast("string")
    )
    placed = placed.withColumn(column, checked).repartitionByRange(column, *order).sortWithinPartitions(column, *order)
    placed.write.partitionBy(column).parquet(f"{path}/{write}")
    made = {unquote(name.split("=", 1)[1]): f"{write}/{name}" for name in names_in(spark, f"{path}/{write}") if name.startswith(f"{column}=")}
    places = {value: place for value, place in listed["places"].items() if value not in wanted} | made
    return _commit(spark, path, listed | {"column": column, "buckets": buckets, "places": places})


def bucket_of(keys: Sequence[str | Column], buckets: int) -> Column:
    """The folder of a key. Keys are hashed as text, so that their types do not matter."""
    texts = [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    return F.pmod(F.xxhash64(*texts), F.lit(buckets)).cast("int")


def upsert_table(
    changes: DataFrame, path: str, schema: StructType, keys: Sequence[str], seq: str | None = None, buckets: int = BUCKETS,
    once: bool = False,
) -> int:
    """Put ``changes`` into the table at ``path`` by key, the last write of a key by
    ``seq`` winning; the number of the commit.

    Only folders whose hash occurs among the changed keys are read and written.
    ``buckets`` counts for a new table; it stays as it began. ``once`` tells that no key
    occurs twice among the changes, as after an aggregate by ``keys``: where the folders
    hold nothing yet, they are not grouped again.
    """
    spark = changes.sparkSession
    kept = _listed(spark, path)
    buckets = kept["buckets"] or buckets
    changed = materialise(changes.withColumn(BUCKET, bucket_of(keys, buckets)), "changes")
    # At most one number for each folder.
    touched = sorted(str(r[0]) for r in changed.select(BUCKET).distinct().collect())
    if not touched:
        return kept["commit"]
    if once and not any(value in kept["places"] for value in touched):
        latest = changed.select(*schema.fieldNames())
    else:
        stored = read_folders(spark, path, schema, only=touched)
        latest = upsert(stored, changed.drop(BUCKET), keys, seq)
    return replace_folders(latest.withColumn(BUCKET, bucket_of(keys, buckets)), path, BUCKET, touched, keys, buckets)


def lookup(spark: SparkSession, path: str, schema: StructType, **key: object) -> DataFrame:
    """Rows of one key, named in the order the table was written with: the only folder
    it can lie in is read, and there the row groups whose range fits."""
    buckets = _listed(spark, path)["buckets"]
    if not buckets:
        return spark.createDataFrame([], schema)
    place = spark.range(1).select(bucket_of([F.lit(v) for v in key.values()], buckets)).first()[0]
    rows = read_folders(spark, path, schema, only=[str(place)])
    for name, value in key.items():
        rows = rows.where(F.col(name) == F.lit(value))
    return rows


def clean(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Remove all commits but the last ``keep`` and the files only they name, also those
    of writes that never came to a commit; what was removed. Not while a write runs."""
    numbers = commits(spark, path)
    kept = numbers[-keep:] if keep else []
    used = {place.split("/")[0] for n in kept for place in _listed(spark, path, n)["places"].values()}
    gone = [f"commits/{n:012d}" for n in numbers if n not in kept]
    gone += [name for name in names_in(spark, path) if name.startswith("write=") and name not in used]
    for name in gone:
        remove(spark, f"{path}/{name}")
    # Folders that a later write replaced, of writes still used for other folders.
    live = {place for n in kept for place in _listed(spark, path, n)["places"].values()}
    for write in used:
        for name in names_in(spark, f"{path}/{write}"):
            if "=" in name and f"{write}/{name}" not in live:
                remove(spark, f"{path}/{write}/{name}")
                gone.append(f"{write}/{name}")
    return gone
