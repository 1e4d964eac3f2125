"""Plans that run slice by slice: same rows, and the disk holds the shuffle files of one slice."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from mergelens.plans import landing, queries
from mergelens.plans.extraction import stored_records
from mergelens.plans.fixtures import PR, Fixtures
from mergelens.session import in_slices, new_dir, slices, stored_in_slices
from mergelens.sources.writers import write_records
from tests.conftest import SF_SMALL, plan_text, rows
from tests.test_disk import _held_files

DAY = datetime.datetime(1996, 3, 1)
ORDERS, LINES, DOCS = 24, 90, 7


def _value(kind: str, n: int):
    if kind.startswith(("bigint", "int", "smallint", "tinyint")):
        return n
    if kind.startswith(("double", "float")):
        return n / 4
    if kind.startswith("timestamp"):
        return DAY + datetime.timedelta(days=40 * n % 1500)
    return DAY.date() if kind == "date" else f"v{n % 5}"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Own rows in the schemas of the test tables, some keys null, some lines and orders twice."""
    path = tmp_path_factory.mktemp("tables")
    own = {
        "lineitem": lambda n: {"l_orderkey": None if n == 5 else n % ORDERS, "l_linenumber": n // ORDERS + 4,
                               "l_partkey": n % 6, "l_suppkey": n % 3},
        "orders": lambda n: {"o_orderkey": None if n == 3 else n, "o_custkey": n % 4, "o_orderstatus": "OF"[n % 2]},
        "customer": lambda n: {"c_nationkey": n},
        "nation": lambda n: {"n_regionkey": n % 2, "n_name": None if n == 2 else f"N{n}"},
        "region": lambda n: {"r_name": f"R{n}"},
        "documents": lambda n: {"text": "Fix crash, add option, update docs " * (40 * n)},
    }
    sizes = {"region": 2, "nation": 4, "customer": 4, "supplier": 3, "part": 6, "orders": ORDERS, "lineitem": LINES,
             "events": 30, "documents": DOCS}
    for name, size in sizes.items():
        schema = spark.read.parquet(f"{SF_SMALL}/{name}.parquet").schema
        made = []
        for n in [*range(size), 1]:
            row = {f.name: _value(f.dataType.simpleString(), n) for f in schema} | own.get(name, lambda n: {})(n)
            if n != 1 or len(made) == 1 or name in ("lineitem", "orders"):
                made.append(tuple(row[f.name] for f in schema))
        spark.createDataFrame(made, schema).coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_every_row_is_in_one_slice(spark):
    df = spark.range(40).select(F.when(F.col("id") % 9 != 0, F.col("id") % 5).alias("key"), "id")
    seen = []
    in_slices(spark, ["key"], 4, lambda cut: seen.append(rows(cut(df))))
    assert len(seen) == 4 and sorted(sum(seen, []), key=repr) == rows(df)
    assert sum((None, 0) in part for part in seen) == 1
    assert stored_in_slices(spark, ["key"], 1, lambda cut: cut(df)) is df
    assert rows(stored_in_slices(spark, ["key"], 3, lambda cut: cut(df))) == rows(df)


@pytest.mark.parametrize(
    "name", ["assemble_pr", "file_array", "flatten_csv", "statistics", "change_reasons", "sink_json", "sink_csv", "csv_side_outputs"]
)
def test_slices_give_the_rows_of_the_whole(spark, folder, monkeypatch, name):
    whole = rows(queries.QUERIES[name](spark, folder))
    counted = []
    for limit in ("WIDE_LINES", "NARROW_LINES"):
        monkeypatch.setattr(queries, limit, 40)
    monkeypatch.setattr(queries, "_slices", lambda fx, lines, made=queries._slices: counted.append(made(fx, lines)) or counted[-1])
    assert rows(queries.QUERIES[name](spark, folder)) == whole
    assert counted == [3] and whole


def test_shuffle_files_of_a_slice_go_before_the_next(spark, folder):
    fx, held, target = Fixtures(spark, folder), [], new_dir(spark, "sliced")
    before = _held_files(spark)

    def write(cut):
        held.append(_held_files(spark) - before)
        write_records(queries._nested(fx, cut), target, "json", "append")

    in_slices(spark, PR, 3, write)
    assert max(held) <= 0 and _held_files(spark) <= before


def test_a_slice_is_cut_from_the_lines_before_they_move(spark, folder):
    fx = Fixtures(spark, folder)
    for made in (queries._nested, queries._flat):
        part = made(fx, next(slices(PR, 3)))
        lines = part._jdf.queryExecution().optimizedPlan().toString().splitlines()
        scans = [n for n, line in enumerate(lines) if "l_orderkey" in line and "Relation" in line]
        assert len(scans) >= 2
        assert all("pmod(xxhash64(l_orderkey" in lines[n - 1] for n in scans)


def test_bodies_do_not_move_by_number(spark, folder, monkeypatch):
    """change_reasons: the body is searched before the join with the messages."""
    seen = []
    monkeypatch.setattr(queries.classify, "classify_nested", lambda df, **more: seen.append(df) or real(df, **more))
    queries.QUERIES["change_reasons"](spark, folder)
    assert "body" not in seen[0].columns and "_keywords" in seen[0].columns


real = queries.classify.classify_nested


def test_landed_patches_do_not_move_by_number(spark, folder):
    """Owners are joined to the files before their texts."""
    fx = Fixtures(spark, folder)
    owners = fx.pull_requests(body=False).select("repository_full_name", "pr_number")
    files = fx.files(owners=owners)
    assert rows(files, *sorted(files.columns)) == rows(fx.files().join(owners, "pr_number"), *sorted(files.columns))
    plan = plan_text(landing.file_pages(files, ["repository_full_name", "pr_number"])).splitlines()
    above = plan[: next(n for n, line in enumerate(plan) if "SortMergeJoin [_doc" in line)]
    assert not any("Exchange" in line for line in above)


def test_first_runs_are_not_merged_with_nothing(spark, tmp_path):
    none = stored_records(spark, str(tmp_path / "nowhere"))
    joined = none.select("id", "title").join(spark.range(3).select(F.col("id").cast("string")), "id", "right_outer")
    assert joined.count() == 3 and "Join" not in joined._jdf.queryExecution().optimizedPlan().toString()
