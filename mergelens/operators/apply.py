"""A caller's function over every repository row, in parallel, with failures kept apart."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

RepositoryFunction = Callable[..., Any]


def apply_per_repository(
    repositories: DataFrame,
    function: RepositoryFunction,
    schema: str,
    key: str = "full_name",
    partitions: int | None = None,
    **kwargs: Any,
) -> DataFrame:
    """Run ``function(row, **kwargs)`` once per repository and flatten what it returns.

    A list of dicts gives several rows, a dict gives one, anything falsy none. A call that raises
    gives one row with ``error`` set. The output has the key, the columns of ``schema`` and
    ``error``. Calls are independent, so rows are dealt evenly to ``partitions`` tasks (by default as
    many as the cluster runs at once), never grouped.
    """
    output = f"{key} string, {schema}, error string"
    arrow = to_arrow_schema(StructType.fromDDL(output))

    def results(row: dict[str, Any]) -> Iterable[dict[str, Any]]:
        try:
            value = function(row, **kwargs)
        except Exception as failure:  # a failing repository must not stop the others
            return [{key: row[key], "error": f"{type(failure).__name__}: {failure}"}]
        if not value:
            return []
        return [{key: row[key], **item} for item in (value if isinstance(value, list) else [value])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [out for row in batch.to_pylist() for out in results(row)]
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    tasks = partitions or repositories.sparkSession.sparkContext.defaultParallelism
    return repositories.repartition(tasks).mapInArrow(run, output)


def split_errors(applied: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(results, failures) of ``apply_per_repository``."""
    return (
        applied.filter(F.col("error").isNull()).drop("error"),
        applied.filter(F.col("error").isNotNull()),
    )
