"""One row per element of an array that is computed in the same query.

The outer form of explode is used on purpose: for the inner form Spark adds a test of the array's
size below the projections that compute it, so the array would be computed twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def each(df: DataFrame, keep: Sequence[str | Column], array: Column, name: str) -> DataFrame:
    """Kept columns and one non-null element per row."""
    exploded = df.select(*keep, F.explode_outer(array).alias(name))
    return exploded.filter(F.col(name).isNotNull())


def each_at(
    df: DataFrame, keep: Sequence[str | Column], array: Column, position: str, name: str
) -> DataFrame:
    """Kept columns, the position from 0 and the element."""
    exploded = df.select(*keep, F.posexplode_outer(array).alias(position, name))
    return exploded.filter(F.col(position).isNotNull())


def each_entry(
    df: DataFrame, keep: Sequence[str | Column], entries: Column, key: str, value: str
) -> DataFrame:
    """Kept columns and one map entry per row."""
    exploded = df.select(*keep, F.explode_outer(entries).alias(key, value))
    return exploded.filter(F.col(key).isNotNull())
