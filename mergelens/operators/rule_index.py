"""Substring rules of any number against texts, by an index of their rarest run of letters.

Testing every rule on every text is a product. Here a rule is filed under the q-gram of it that fewest
rules have; a text fetches candidates by its own q-grams, and ``contains`` verifies them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mergelens.functions.keywords import Finder
from mergelens.session import cut_lineage

#: Rules up to which the index is broadcast (about 100 bytes each); beyond, its join shuffles.
BROADCAST_RULES = 200_000
#: Texts whose matches are sent together.
ROWS = 1024


def grams(text: Column, size: int) -> Column:
    """The distinct runs of ``size`` signs; one pass over the text."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=({'.' * size}))."), 1))


def rule_index(rules: DataFrame, q: int = 3) -> DataFrame:
    """rule, pattern and gram of each rule (``rule``, ``pattern``); empty and null patterns are left out.

    The gram is the one of least use among the rules, ties by text; patterns shorter than ``q`` are
    filed under themselves.
    """
    kept = rules.select("rule", "pattern").filter(F.length("pattern") > 0)
    held = kept.withColumn(
        "gram",
        F.explode(F.when(F.length("pattern") < q, F.array("pattern")).otherwise(grams(F.col("pattern"), q))),
    )
    uses = held.groupBy("gram").agg(F.count(F.lit(1)).alias("uses"))
    return (
        held.join(uses, "gram")
        .groupBy("rule", "pattern")
        .agg(F.min(F.struct("uses", "gram")).alias("least"))
        .select("rule", "pattern", F.col("least.gram").alias("gram"))
    )


def rule_matches(texts: DataFrame, key: str, text: str, rules: DataFrame, q: int = 3) -> DataFrame:
    """``key`` and ``rule`` of every rule whose pattern is part of the text; case matters.

    A row matches a rule once. Null texts match nothing; rows of equal key are rows of their own.
    Texts are read once, in place, while the index is broadcast, up to BROADCAST_RULES rules; beyond that
    their grams are shuffled and the candidates joined to the texts, of which ``key`` must be unique.
    """
    index = cut_lineage(rule_index(rules, q).withColumn("_number", F.monotonically_increasing_id()))
    rows = texts.select(F.col(key).alias("_key"), F.col(text).alias("_text")).filter(F.col("_text").isNotNull())
    if index.count() <= BROADCAST_RULES:
        found = rows.mapInArrow(_matcher(index), StructType([rows.schema["_key"], index.schema["_number"]]))
        named = found.join(F.broadcast(index.select("_number", "rule")), "_number")
        return named.select(F.col("_key").alias(key), "rule")
    sizes = [r[0] for r in index.select(F.least(F.length("pattern"), F.lit(q))).distinct().collect()]
    cut = rows.withColumn("_grams", F.flatten(F.array(*[grams(F.col("_text"), size) for size in sorted(sizes)])))
    found = cut.select("_key", F.explode_outer("_grams").alias("gram")).join(index, "gram").select("_key", "rule", "pattern")
    return found.join(rows, "_key").filter(F.contains("_text", "pattern")).select(F.col("_key").alias(key), "rule")


def _matcher(index: DataFrame) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The bytes of each text fetch the rules filed under their gram, and verify them."""
    shared = index.sparkSession.sparkContext.broadcast(index.select("_number", "pattern", "gram").toArrow())

    def matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        names = held.column("_number").combine_chunks()
        finder = Finder(held.column("pattern").to_pylist(), held.column("gram").to_pylist())
        for batch in batches:
            for first in range(0, len(batch), ROWS):
                part = batch.slice(first, ROWS)
                rows, numbers = finder.found(part.column("_text"))
                keys = part.column("_key").take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([keys, names.take(pa.array(numbers))], ["_key", "_number"])

    return matches
