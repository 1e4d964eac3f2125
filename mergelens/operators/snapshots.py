"""Result snapshots over time: newest record, component state, refresh plan, merge, compaction.

The key of a pull request is (repository_name, id); it is unique in a state, so joins on it are
balanced. Snapshots repeat keys, and those repeats shrink on the map side (group limits, partial
aggregates).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergelens.functions.rules import BASIC_CONFIDENCE, REASON_REUSED
from mergelens.operators.ranking import first_row, row_positions

KEY = ("repository_name", "id")
FLAGS = ("has_commits", "has_comments", "has_files")


def newest_first(
    time: str = "mtime", file: str | None = "file", position: str | None = "pos"
) -> list[Column]:
    """Newest file first, then file name descending, then position in the file."""
    order = [F.col(time).desc()]
    if file:
        order.append(F.col(file).desc())
    if position:
        order.append(F.col(position).asc())
    return order


def keyed(records: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Records that have their key."""
    present = F.lit(True)
    for name in key:
        present = present & F.col(name).isNotNull()
    return records.filter(present)


def latest_records(
    records: DataFrame, order: Sequence[Column] | None = None, key: Sequence[str] = KEY
) -> DataFrame:
    """One record per key: the first in ``order`` (newest file first by default)."""
    return first_row(keyed(records, key), key, order or newest_first())


def component_status(
    records: DataFrame, order: Sequence[Column] | None = None, key: Sequence[str] = KEY
) -> DataFrame:
    """State rows (key, ``has_*``, ``timestamp``) of the newest records.

    Use ``stats.with_presence(..., 'key')`` to set the flags of nested records first.
    """
    return latest_records(records, order, key).select(*key, *FLAGS, "timestamp")


def state_summary(state: DataFrame) -> DataFrame:
    return state.agg(
        F.count(F.lit(1)).alias("prs"),
        F.count_distinct("repository_name").alias("repositories"),
        *[F.count_if(F.col(flag)).alias(f"with_{flag.removeprefix('has_')}") for flag in FLAGS],
    )


def state_per_repository(state: DataFrame) -> DataFrame:
    return state.groupBy("repository_name").agg(F.count(F.lit(1)).alias("prs"))


def mark_needs(
    prs: DataFrame,
    state: DataFrame,
    include: tuple[bool, bool, bool] = (True, True, True),
    key: Sequence[str] = KEY,
) -> DataFrame:
    """Add ``is_new`` and ``need_commits``, ``need_comments``, ``need_files``.

    A component is needed when it is requested and the state does not have it.
    """
    known = state.select(*key, *FLAGS, F.lit(True).alias("_known"))
    joined = prs.join(known, list(key), "left")
    needs = {"is_new": F.col("_known").isNull()}
    for flag, wanted in zip(FLAGS, include, strict=True):
        missing = ~F.coalesce(F.col(flag), F.lit(False))
        needs[flag.replace("has_", "need_")] = F.lit(wanted) & missing
    return joined.withColumns(needs).drop("_known", *FLAGS)


def _any_need() -> Column:
    return F.col("need_commits") | F.col("need_comments") | F.col("need_files")


def needs_refresh(
    prs: DataFrame,
    state: DataFrame,
    include: tuple[bool, bool, bool] = (True, True, True),
    key: Sequence[str] = KEY,
) -> DataFrame:
    """Unseen pull requests and those that lack a requested component."""
    return mark_needs(prs, state, include, key).filter(F.col("is_new") | _any_need())


def new_only(prs: DataFrame, state: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Unseen pull requests only."""
    return prs.join(state.select(*key), list(key), "left_anti")


def refresh_plan(
    prs: DataFrame,
    state: DataFrame,
    include: tuple[bool, bool, bool] = (True, True, True),
    key: Sequence[str] = KEY,
) -> DataFrame:
    """How many pull requests are new, skipped, and lack each component."""
    known = ~F.col("is_new")
    return mark_needs(prs, state, include, key).agg(
        F.count_if(F.col("is_new")).alias("new_prs"),
        F.count_if(known & ~_any_need()).alias("skipped"),
        F.count_if(known & F.col("need_commits")).alias("update_commits"),
        F.count_if(known & F.col("need_comments")).alias("update_comments"),
        F.count_if(known & F.col("need_files")).alias("update_files"),
    )


def non_empty(items: Column) -> Column:
    return F.coalesce(F.when(items.isNotNull(), F.size(items) > 0), F.lit(False))


def has_content(df: DataFrame, name: str, value: Column) -> Column:
    """Whether a kept column has content: a non-empty text, array or map, any other non-null."""
    kind = dict(df.dtypes)[name]
    if kind.startswith(("array", "map")):
        return non_empty(value)
    if kind == "string":
        return F.coalesce(value, F.lit("")) != ""
    return value.isNotNull()


def merge_snapshots(
    old: DataFrame,
    new: DataFrame,
    key: Sequence[str] = KEY,
    components: Sequence[str] = ("commits", "pr_comments", "files"),
    kept: Mapping[str, Sequence[str]] | None = None,
    how: str = "full_outer",
) -> DataFrame:
    """Component-wise upsert of ``new`` into ``old``; both hold one row per key.

    A component comes from the new row unless it is empty there. A column of ``kept`` stays as it is
    in the old row when it has content there, and the columns listed with it stay with it; else all
    of them come from the new row. All other columns come from the new row, or from the old one
    where there is no new row; with ``how="right_outer"`` only keys of ``new`` are kept.
    """
    kept = {name: tuple(others) for name, others in (kept or {}).items()}
    leader = {other: name for name, others in kept.items() for other in (name, *others)}
    columns = [c for c in new.columns if c not in key]
    left = old.select(*key, F.struct(*[c for c in old.columns if c not in key]).alias("_old"))
    right = new.select(*key, F.struct(*columns).alias("_new"))
    both = left.join(right, list(key), how)

    def merged(name: str) -> Column:
        before, after = F.col("_old")[name], F.col("_new")[name]
        if name in components:
            return F.when(non_empty(after), after).otherwise(F.coalesce(before, after))
        if name in leader:
            first = leader[name]
            return F.when(has_content(old, first, F.col("_old")[first]), before).otherwise(after)
        return F.when(F.col("_new").isNotNull(), after).otherwise(before)

    return both.select(*key, *[merged(name).alias(name) for name in columns])


#: An earlier change type is reused with what explains it, and so are earlier tags.
REUSED = {"change_type": ("change_type_confidence", "change_type_reasons"), "tags": ()}


def merge_records(
    old: DataFrame, new: DataFrame, key: Sequence[str] = KEY, how: str = "full_outer"
) -> DataFrame:
    """``merge_snapshots`` for full records: an earlier change type and earlier tags are reused."""
    prepared = old.withColumns(
        {
            "change_type_confidence": F.coalesce(
                F.col("change_type_confidence"), F.lit(BASIC_CONFIDENCE)
            ),
            "change_type_reasons": F.coalesce(
                F.col("change_type_reasons"), F.array(F.lit(REASON_REUSED))
            ),
        }
    )
    return merge_snapshots(prepared, new, key, kept=REUSED, how=how).select(*old.columns)


def merge_history(
    records: DataFrame,
    order: Column,
    key: Sequence[str] = KEY,
    components: Sequence[str] = ("commits", "pr_comments", "files"),
    kept: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """``merge_snapshots`` over any number of snapshots at once, oldest to newest by ``order``.

    A component is the newest non-empty one (without any, the newest that is not null), a kept
    column and those listed with it the oldest with content (without any, the newest), every other
    column that of the newest row. ``order`` must be total within a key, such as a struct of time,
    file and position; then arrival does not matter and late files cannot overwrite newer content.
    It is one aggregation, so a key with many snapshots shrinks before the shuffle.
    """
    kept = {name: tuple(others) for name, others in (kept or {}).items()}
    led = [other for name, others in kept.items() for other in (name, *others)]
    others = [c for c in records.columns if c not in (*key, *components, *led)]
    rows = keyed(records, key).withColumn("_order", order)
    when = F.col("_order")
    merged = rows.groupBy(*key).agg(
        F.max_by(F.struct(*others), when).alias("_newest"),
        *[
            F.coalesce(
                F.max_by(F.col(name), F.when(non_empty(F.col(name)), when)),
                F.max_by(F.col(name), F.when(F.col(name).isNotNull(), when)),
            ).alias(name)
            for name in components
        ],
        *[
            F.coalesce(
                F.min_by(
                    F.struct(name, *with_it), F.when(has_content(records, name, F.col(name)), when)
                ),
                F.max_by(F.struct(name, *with_it), when),
            ).alias(f"_{name}")
            for name, with_it in kept.items()
        ],
    )
    leader = {other: name for name, with_it in kept.items() for other in (name, *with_it)}

    def found(name: str) -> Column:
        if name in leader:
            return F.col(f"_{leader[name]}")[name].alias(name)
        return F.col("_newest")[name].alias(name) if name in others else F.col(name)

    return merged.select(*[found(name) for name in records.columns])


def fold_state(rows: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """State of any number of status rows: flags OR-merge, the newest timestamp wins.

    The fold does not depend on order or grouping, so it can run again over its own result.
    """
    return rows.groupBy(*key).agg(
        *[F.bool_or(F.coalesce(F.col(flag), F.lit(False))).alias(flag) for flag in FLAGS],
        F.max("timestamp").alias("timestamp"),
    )


def update_state(state: DataFrame, saved: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """State after a save: new keys come in, known keys gain flags and the new timestamp."""
    columns = [*key, *FLAGS, "timestamp"]
    return fold_state(state.select(*columns).unionByName(saved.select(*columns)), key)


def assign_batches(
    prs: DataFrame, size: int, order: Sequence[Column], keys: Sequence[str] = ("repository_name",)
) -> DataFrame:
    """Add ``position``, ``batch`` and ``batches``: runs of ``size`` within each repository."""
    numbered = row_positions(prs, keys, order, "position")
    counts = prs.groupBy(*keys).agg(
        F.ceil(F.count(F.lit(1)) / F.lit(size)).cast("bigint").alias("batches")
    )
    return numbered.join(counts, list(keys)).withColumn(
        "batch", F.expr(f"(position - 1) div {int(size)} + 1")
    )


def with_batches(
    records: DataFrame,
    size: int,
    order: Sequence[str] = ("id",),
    placed: Sequence[str] = (),
    listed: DataFrame | None = None,
) -> DataFrame:
    """``records`` with ``position``, ``batch`` and ``batches``; only their keys are numbered.

    Keys must be unique. ``placed`` names columns that the records were last joined by, never null
    in a record with keys: the numbers then come to the records, which are not shuffled again.
    ``listed`` has these columns and the keys, a row for each record, where records are dear to make.
    """
    keys = ["repository_name", *order]
    narrow = (records if listed is None else listed).select(*dict.fromkeys([*keys, *placed]))
    numbers = assign_batches(narrow, size, [F.col(c) for c in order])
    if not placed:
        return records.join(numbers, keys)
    # Spark shuffles by all columns that are tested with "=", so the keys are tested otherwise.
    own, given = records.alias("_own"), numbers.alias("_given")
    same = reduce(
        lambda a, b: a & b,
        [F.col(f"_own.{c}") == F.col(f"_given.{c}") for c in placed]
        + [
            (F.col(f"_own.{c}") >= F.col(f"_given.{c}")) & (F.col(f"_own.{c}") <= F.col(f"_given.{c}"))
            for c in keys
            if c not in placed
        ],
    )
    return own.join(given, same).select("_own.*", "_given.position", "_given.batch", "_given.batches")


def batch_name(repository: Column, batch: Column, batches: Column) -> Column:
    """``{repository}_batch_{i}_of_{n}``."""
    return F.concat(
        repository, F.lit("_batch_"), batch.cast("string"), F.lit("_of_"), batches.cast("string")
    )


def compact(
    records: DataFrame, path: str, order: Sequence[Column] | None = None,
    key: Sequence[str] = KEY, by: str = "repository_name", file_format: str = "parquet",
) -> None:
    """Write the newest records, partitioned by repository, to a new folder.

    The rebalance hint groups rows by repository but lets adaptive execution split a huge one.
    """
    (
        latest_records(records, order, key)
        .hint("rebalance", by)
        .write.mode("errorifexists")
        .partitionBy(by)
        .format(file_format)
        .save(path)
    )
