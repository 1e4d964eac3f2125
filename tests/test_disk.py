"""What a save keeps on disk: records move once to their file, shuffle files go with the write."""

from __future__ import annotations

from pyspark.sql import functions as F

from mergelens.operators.snapshots import with_batches
from mergelens.session import freed_shuffles, new_dir


def _records(spark):
    """250 records that were last joined by their number, half of a repository each."""
    numbers = spark.range(250).select(
        F.col("id").alias("pr_number"),
        F.concat(F.lit("o/r_"), F.col("id").cast("string")).alias("id"),
        F.when(F.col("id") % 2 == 0, F.lit("even")).otherwise(F.lit("odd")).alias("repository_name"),
    )
    wide = spark.range(250).select(F.col("id").alias("pr_number"), F.repeat(F.lit("x"), F.lit(50)).alias("patch"))
    joined = numbers.hint("merge").join(wide, "pr_number")
    return joined, numbers


def _held_files(spark) -> int:
    return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()


def test_placed_records_get_the_same_batches_without_a_shuffle(spark):
    joined, numbers = _records(spark)
    columns = ["pr_number", "id", "repository_name", "patch", "position", "batch", "batches"]
    moved = with_batches(joined, 40).select(*columns)
    placed = with_batches(joined.hint("merge"), 40, placed=("pr_number",), listed=numbers).select(*columns)
    assert sorted(placed.collect()) == sorted(moved.collect())
    assert {(r.repository_name, r.batches) for r in placed.collect()} == {("even", 4), ("odd", 4)}
    plan = placed._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.split("== Initial Plan ==")[-1].splitlines() if "Exchange hashpartitioning" in line]
    # Both sides of the join that made the records and the numbers; nothing by repository and id.
    assert shuffled and not any("hashpartitioning(repository_name" in line and ", id" in line for line in shuffled)


def test_shuffle_files_go_when_the_write_ends(spark):
    joined, _ = _records(spark)
    before = _held_files(spark)
    with freed_shuffles(spark):
        joined.repartition(3, "id").write.parquet(new_dir(spark, "freed"))
    assert _held_files(spark) <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
