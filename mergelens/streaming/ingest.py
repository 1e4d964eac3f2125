"""New result files as they arrive, folded into state.

Every micro-batch writes only its own rows to ``batch_id=<n>`` of the target; a replayed batch
overwrites its own folder, so delivery is exactly-once. Readers merge the folders by content time,
not by arrival, so a late file cannot win over a newer one. ``compact_batches`` rewrites the
folders into one when there are many.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from mergelens.operators.snapshots import (
    FLAGS,
    KEY,
    fold_state,
    keyed,
    latest_records,
    merge_history,
    newest_first,
)

BatchFunction = Callable[[DataFrame], DataFrame]


def read_result_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    file_format: str = "parquet",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """A stream over a folder of result files; the schema is never inferred."""
    reader = spark.readStream.schema(schema).format(file_format)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.option("recursiveFileLookup", True).load(path)


def _start(
    stream: DataFrame, transform: BatchFunction, target: str, checkpoint: str, mode: str
) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_ingest(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    order: Sequence[Column] | None = None,
    key: Sequence[str] = KEY,
) -> StreamingQuery:
    """Append the newest record per key of every micro-batch."""
    return _start(
        stream, lambda batch: latest_records(batch, order, key), target, checkpoint, "append"
    )


def start_append(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append every row of a micro-batch; ``merge_history`` folds them when they are read."""
    return _start(stream, lambda batch: batch, target, checkpoint, "append")


def without_repeats(stream: DataFrame, key: Sequence[str], time: str, within: str) -> DataFrame:
    """Each key once, if its repeats come within a span of event time (such as "2 days").

    Keys are remembered until the watermark has passed them, so memory follows the span and not the
    length of the stream. Rows later than the span are left out, so it must cover the lateness.
    """
    return stream.withWatermark(time, within).dropDuplicatesWithinWatermark(list(key))


def start_state(
    stream: DataFrame, target: str, checkpoint: str, key: Sequence[str] = KEY
) -> StreamingQuery:
    """Keep component flags per key in Spark's state store; write the keys that changed.

    State never expires. Use the RocksDB state store on a cluster.
    """
    folded = fold_state(keyed(stream, key), key)
    return _start(folded, lambda batch: batch, target, checkpoint, "update")


def read_batches(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target)


def current_records(
    spark: SparkSession,
    target: str,
    order: Sequence[Column] | None = None,
    key: Sequence[str] = KEY,
) -> DataFrame:
    """Newest record per key over all batches so far."""
    rows = read_batches(spark, target).drop("batch_id")
    return latest_records(rows, order or newest_first(), key)


def current_merge(
    spark: SparkSession,
    target: str,
    order: Column,
    key: Sequence[str] = KEY,
    components: Sequence[str] = ("commits", "pr_comments", "files"),
    kept: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Component-wise merge over all batches so far."""
    rows = read_batches(spark, target).drop("batch_id")
    return merge_history(rows, order, key, components, kept)


def current_state(spark: SparkSession, target: str, key: Sequence[str] = KEY) -> DataFrame:
    """State per key over all written updates (flags only ever turn on); empty before the first."""
    columns = [*key, *FLAGS, "timestamp"]
    try:
        rows = read_batches(spark, target).select(*columns)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        kinds = [f"{c} boolean" if c in FLAGS else f"{c} string" for c in columns]
        rows = spark.createDataFrame([], ", ".join(kinds))
    return fold_state(rows, key)


def compact_batches(spark: SparkSession, source: str, target: str, view: BatchFunction) -> None:
    """Write ``view`` of all batches as the first batch of a new folder."""
    rows = read_batches(spark, source).drop("batch_id")
    view(rows).write.mode("errorifexists").parquet(f"{target}/batch_id=-1")


def run_to_end(query: StreamingQuery) -> None:
    """Wait until an ``availableNow`` query has read everything."""
    query.awaitTermination()
    failure = query.exception()
    if failure is not None:
        raise failure
