"""Session settings and the shared folder that all executors can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}
#: Gives the rows of a frame that are in a slice.
Cut = Callable[[DataFrame], DataFrame]
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(
    app_name: str = "mergelens", master: str | None = None, **extra: str
) -> SparkSession:
    """A session with adaptive execution on; ``extra`` takes conf names with ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only in local mode.

    The checkpoint folder of the context is set to the same place.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return configured or current
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="mergelens-")
    context.setCheckpointDir(configured)
    return configured


def new_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder (not yet created)."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes in this block delete their shuffle files when they end, not when the driver is collected."""
    before = spark.conf.get(_FREE_SHUFFLES)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are written once and read back by every later use."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def whole(df: DataFrame) -> DataFrame:
    return df


def slices(key: Sequence[str], parts: int) -> Iterator[Cut]:
    """For each of ``parts`` slices by ``key`` what cuts it from a frame; every row, also one without key, is in one."""
    for number in range(parts):
        wanted = F.pmod(F.xxhash64(*key), F.lit(parts)) == number
        yield whole if parts == 1 else lambda df, wanted=wanted: df.where(wanted)


def in_slices(spark: SparkSession, key: Sequence[str], parts: int, run: Callable[[Cut], None]) -> None:
    """``run`` for each slice, one after the other, with what cuts it from the frames that go by ``key``.

    Frames are cut before they are joined and moved, so the disk holds the shuffle files of one slice at
    a time; what is joined otherwise is read once a slice.
    """
    with freed_shuffles(spark):
        for cut in slices(key, parts):
            run(cut)


def stored_in_slices(
    spark: SparkSession, key: Sequence[str], parts: int, made: Callable[[Cut], DataFrame]
) -> DataFrame:
    """The rows that ``made`` gives for each slice, written and read back; those of one slice stay as they are."""
    if parts == 1:
        return made(whole)
    path = new_dir(spark, "slices")
    in_slices(spark, key, parts, lambda cut: made(cut).write.mode("append").option("compression", "zstd").parquet(path))
    return spark.read.schema(made(whole).schema).parquet(path)
