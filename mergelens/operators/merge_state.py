"""The component-wise merge of snapshots as a state that later snapshots can be folded into.

``snapshots.merge_history`` needs all snapshots at once: of a merged record it is not known how old
each component is, so a late file could lose against older content. Here every part of a record
keeps the order of the snapshot it came from. Folding does not depend on order or grouping, and may
run again over its own result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergelens.operators.snapshots import KEY, has_content, keyed, non_empty


@dataclass(frozen=True)
class Merge:
    """What ``merge_history`` takes: key, components, kept columns with those that go with them."""

    key: Sequence[str] = KEY
    components: Sequence[str] = ("commits", "pr_comments", "files")
    kept: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def others(self, columns: Sequence[str]) -> list[str]:
        led = [c for name, with_it in self.kept.items() for c in (name, *with_it)]
        return [c for c in columns if c not in (*self.key, *self.components, *led)]


def merge_state(records: DataFrame, order: Column, merge: Merge) -> DataFrame:
    """One state row for each record that has its key; ``fold_merge`` unites those of a key."""
    rows = keyed(records, merge.key).withColumn("_order", order)
    when = F.col("_order").alias("at")
    parts = [F.struct(when, *merge.others(records.columns)).alias("newest")]
    for name in merge.components:
        value = F.struct(non_empty(F.col(name)).alias("full"), when, F.col(name).alias("value"))
        parts.append(F.when(F.col(name).isNotNull(), value).alias(f"part_{name}"))
    for name, with_it in merge.kept.items():
        value = F.struct(when, name, *with_it)
        parts.append(F.when(has_content(records, name, F.col(name)), value).alias(f"first_{name}"))
        parts.append(value.alias(f"last_{name}"))
    return rows.select(*merge.key, *parts)


def fold_merge(states: DataFrame, merge: Merge) -> DataFrame:
    """One state row per key: one aggregation, which begins on the map side."""
    at = lambda name: F.col(name)["at"]
    parts = [F.max_by("newest", at("newest")).alias("newest")]
    for name in merge.components:
        column = f"part_{name}"
        rank = F.when(F.col(column).isNotNull(), F.struct(F.col(column)["full"], at(column)))
        parts.append(F.max_by(column, rank).alias(column))
    for name in merge.kept:
        parts.append(F.min_by(f"first_{name}", at(f"first_{name}")).alias(f"first_{name}"))
        parts.append(F.max_by(f"last_{name}", at(f"last_{name}")).alias(f"last_{name}"))
    return states.groupBy(*merge.key).agg(*parts)


def merged_records(state: DataFrame, columns: Sequence[str], merge: Merge) -> DataFrame:
    """The merged records of a folded state, with the columns of the records it came from."""
    leader = {c: name for name, with_it in merge.kept.items() for c in (name, *with_it)}

    def found(name: str) -> Column:
        if name in merge.key:
            return F.col(name)
        if name in merge.components:
            return F.col(f"part_{name}")["value"].alias(name)
        if name in leader:
            first, last = F.col(f"first_{leader[name]}"), F.col(f"last_{leader[name]}")
            return F.when(first.isNotNull(), first[name]).otherwise(last[name]).alias(name)
        return F.col("newest")[name].alias(name)

    return state.select(*[found(name) for name in columns])


def merge_pair(old: DataFrame, new: DataFrame, merge: Merge) -> DataFrame:
    """``fold_merge`` of two folded states as a join on the key, so that neither side is grouped again."""
    key, columns = list(merge.key), [c for c in old.columns if c not in merge.key]
    left = old.select(*key, *[F.col(c).alias(f"_old_{c}") for c in columns])
    right = new.select(*key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    both = left.join(right, key, "full_outer")

    def chosen(name: str) -> Column:
        before, after = F.col(f"_old_{name}"), F.col(f"_new_{name}")
        if name.startswith("part_"):
            rank = lambda value: F.struct(value["full"], value["at"])
            later = rank(after) > rank(before)
        elif name.startswith("first_"):
            later = after["at"] < before["at"]
        else:
            later = after["at"] > before["at"]
        return F.when(before.isNull() | (after.isNotNull() & later), after).otherwise(before).alias(name)

    return both.select(*key, *[chosen(c) for c in columns])
