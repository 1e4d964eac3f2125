"""Shards by jump consistent hashing (Lamping and Veach, 2014)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergelens.llm.positions import numbered

#: Fixed values of the published algorithm.
_STEP = np.uint64(2862933555777941757)
_SPAN = float(1 << 31)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key: a key moves only to the shard that is added, if at all."""
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    ahead = np.zeros(len(state), np.int64)
    moving = np.arange(len(state))
    while len(moving):
        shard[moving] = ahead[moving]
        state[moving] = state[moving] * _STEP + np.uint64(1)
        draw = (state[moving] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[moving] = ((shard[moving] + 1).astype(np.float64) * (_SPAN / draw)).astype(np.int64)
        moving = moving[ahead[moving] < shards]
    return shard


def stable_key(column: Column) -> Column:
    """60 bits of the MD5 of the value as text; a null counts as the empty text."""
    digest = F.md5(F.coalesce(column.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def shard_of(key: Column, shards: int) -> Column:
    """The jump shard of a key column; the loop runs over Arrow batches of keys only."""

    @F.pandas_udf("int")
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for keys in batches:
            yield pd.Series(jump(keys.to_numpy(np.int64), shards).astype(np.int32))

    return place(key)


def deal(docs: DataFrame, key: str, text: str, shards: int) -> DataFrame:
    """``key``, size, text_crc32, shard, slot and grown_shard of every row.

    A row's shard depends on its key and the number of shards alone, so equal texts need not meet
    and a source with a third of all rows spreads like any other. ``grown_shard`` is the shard if
    one more is appended. Slots follow the key (then size and checksum) inside a shard. Null text:
    16 bytes and checksum 0. Null keys share one shard; rows with equal keys share a shard and get
    slots of their own. Columns of other names are not read, so they may be called anything.
    """
    facts = docs.select(
        F.col(key).alias("key"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
    ).withColumn("hashed", stable_key(F.col("key")))
    placed = facts.select(
        "key",
        "size",
        "text_crc32",
        shard_of(F.col("hashed"), shards).alias("shard"),
        shard_of(F.col("hashed"), shards + 1).alias("grown_shard"),
    )
    order = [F.col("key").asc_nulls_first(), F.col("size").asc(), F.col("text_crc32").asc()]
    return numbered(placed, ["shard"], order, "slot").withColumnRenamed("key", key)
