"""Small helpers the operators of this package share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag.session import materialise

__all__ = ["aside", "content_key", "lower_ascii", "materialise", "on_workers", "table", "without"]

# Keys that are broadcast to drop rows; above it both sides are shuffled.
BROADCAST_KEYS = 2_000_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def on_workers(spark: SparkSession) -> None:
    """Let Python workers of this machine import the package from where it lies.

    A cluster gets it by ``--py-files`` or an installed package; the extra path is
    then one that does not exist.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other letter as it is."""
    return F.translate(text, _UPPER, _UPPER.lower())


def content_key(*columns: str) -> Column:
    """128 bits that stand for the values of some columns of a row, nulls told apart."""
    parts = [part for c in columns for part in (F.col(c), F.col(c).isNull())]
    return F.struct(*[F.xxhash64(F.lit(seed), *parts).alias(f"h{seed}") for seed in (1, 2)])


def unused(name: str) -> str:
    """A column name no table has."""
    return f"{name}_{uuid.uuid4().hex}"


def without(rows: DataFrame, gone: DataFrame, *keys: Column) -> DataFrame:
    """``rows`` without those whose ``keys`` are a row of the written table ``gone``."""
    names = [unused("key") for _ in keys]
    few = gone.count() <= BROADCAST_KEYS
    out = gone.toDF(*names)
    keyed = rows.withColumns(dict(zip(names, keys, strict=True)))
    return keyed.join(F.broadcast(out) if few else out, names, "left_anti").select(*rows.columns)


def aside(rows: DataFrame, *names: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``rows`` with the columns ``names``, where they are there, under other names, and a
    function that gives them their names again."""
    moved = {c: unused(c) for c in rows.columns if c in names}
    back = {new: old for old, new in moved.items()}
    return rows.withColumnsRenamed(moved), lambda df: df.withColumnsRenamed(back)
