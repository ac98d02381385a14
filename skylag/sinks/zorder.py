"""Tables stored so that a lookup by any of several keys reads few files.

Each key is cut into ranges of about equally many rows; the range numbers of a row,
their bits interleaved, are its place on a curve, and files are ranges of that curve.
So a file spans a small part of each key, not of the first one alone. Beside the
files lies a list of the smallest and largest key of each; a lookup opens only files
whose span holds its values, and in them Bloom filters rule out most of the rest.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag.session import materialise, scratch

BITS = 8
# Rows the range bounds of the keys are taken from, about.
SAMPLE = 20_000


def _bounds(df: DataFrame, keys: Sequence[str], sample: int) -> list[list]:
    """For each key the values that cut a sample of the rows into equal parts."""
    rows = df.count()
    share = min(1.0, sample / max(rows, 1))
    part = df.select(*keys) if share == 1 else df.select(*keys).sample(False, share, 7)
    found = part.limit(2 * sample).collect()
    cuts = []
    for at in range(len(keys)):
        values = sorted(row[at] for row in found if row[at] is not None)
        steps = {values[len(values) * i // (1 << BITS)] for i in range(1, 1 << BITS)} if values else set()
        cuts.append(sorted(steps))
    return cuts


def _number(key: str, cuts: list) -> Column:
    """How many bounds are not above the key, by halving; NULL comes first."""
    if not cuts:
        return F.lit(0)
    bounds = F.array(*[F.lit(c) for c in cuts])
    steps = F.array(*[F.lit(1 << bit) for bit in range(len(cuts).bit_length() - 1, -1, -1)])

    def further(at: Column, step: Column) -> Column:
        return F.when(F.get(bounds, at + step - 1) <= F.col(key), at + step).otherwise(at)

    return F.when(F.col(key).isNull(), 0).otherwise(F.aggregate(steps, F.lit(0), further))


def curve(numbers: Sequence[Column]) -> Column:
    """The bits of some numbers of ``BITS`` bits, interleaved, the highest first."""
    place = F.lit(0).cast("long")
    for bit in range(BITS - 1, -1, -1):
        for number in numbers:
            one = F.shiftright(number, bit).bitwiseAND(F.lit(1)).cast("long")
            place = F.shiftleft(place, 1).bitwiseOR(one)
    return place


def write_zordered(
    df: DataFrame, path: str, keys: Sequence[str], files: int | None = None, sample: int = SAMPLE
) -> None:
    """Replace ``path`` by files along the curve of ``keys``, seven at most, and the
    list of their spans. The bounds come from about ``sample`` rows; all rows are
    stored, and a wrong bound costs reading, never rows. ``df`` is computed once: its
    rows lie in the work folder while they are counted, sampled and dealt."""
    if not 0 < len(keys) <= 63 // BITS:
        raise ValueError(f"between one and {63 // BITS} keys: {list(keys)}")
    with scratch(df.sparkSession):
        rows = materialise(df, "rows")
        cuts = _bounds(rows, keys, sample)
        names = [f"_range{i}" for i in range(len(keys))]
        numbered = rows.withColumns({n: _number(k, c) for n, k, c in zip(names, keys, cuts, strict=True)})
        placed = numbered.withColumn("_curve", curve([F.col(n) for n in names])).drop(*names)
        order = ["_curve", *keys]
        ranges = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
        writer = ranges.sortWithinPartitions(*order).drop("_curve").write.mode("overwrite")
        for key in keys:
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        writer.parquet(f"{path}/rows")
    stored = df.sparkSession.read.parquet(f"{path}/rows")
    spans = [f(k).alias(f"{n}_{k}") for k in keys for n, f in (("min", F.min), ("max", F.max), ("nulls", lambda k: F.count_if(F.col(k).isNull())))]
    stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(*spans).write.mode("overwrite").parquet(f"{path}/spans")


def lookup_files(spark: SparkSession, path: str, **keys: object) -> list[str]:
    """Files whose span holds a value, or NULL, for every key given."""
    spans = spark.read.parquet(f"{path}/spans")
    tests = [
        F.col(f"nulls_{k}") > 0 if v is None else (F.col(f"min_{k}") <= F.lit(v)) & (F.col(f"max_{k}") >= F.lit(v))
        for k, v in keys.items()
    ]
    fits = reduce(lambda a, b: a & b, tests, F.lit(True))
    return sorted(row.file for row in spans.where(fits).select("file").collect())


def lookup(spark: SparkSession, path: str, **keys: object) -> DataFrame:
    """The rows that have all the values given, from the files that can hold them."""
    schema = spark.read.parquet(f"{path}/rows").schema
    found = lookup_files(spark, path, **keys)
    rows = spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)
    return reduce(lambda df, kv: df.where(F.col(kv[0]).eqNullSafe(F.lit(kv[1]))), keys.items(), rows)
