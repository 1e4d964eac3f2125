"""Every registered query against its SQL counterpart, on whole tables."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from mergelens.plans.oracles import ORACLES
from mergelens.plans.queries import QUERIES
from tests.compare import compare, connect
from tests.conftest import SF_SMALL, plan_text

ROWS_ONLY = {"tokens_stemmed"}
WRITES = {"scan_envelope", "sink_json", "sink_csv", "scan_quarantine", "compact"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_SMALL)


def test_names_agree():
    assert set(ORACLES) | ROWS_ONLY == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


def test_entry_works_without_the_subpackage():
    code = (
        "import sys; sys.modules.update({'mergelens.llm': None, 'corpus_pipeline': None})\n"
        "import __spark_entry__ as e; from mergelens.plans.queries import QUERIES\n"
        "assert set(e.queries()) == set(QUERIES) and set(e.oracle_sql()) <= set(QUERIES)"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(entry.__file__).parent)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    count, _, _ = compare(spark, duck, SF_SMALL, entry.queries()[name], entry.oracle_sql()[name])
    assert count > 0


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_query_runs(spark, name):
    assert entry.queries()[name](spark, SF_SMALL).count() > 0


def test_entry_has_the_three_types(spark):
    assert {r["change_type"] for r in entry.entry(spark).collect()} == {"fix", "feature", "doc"}


@pytest.mark.parametrize(
    "name", sorted(n for n in QUERIES if n not in WRITES and not n.startswith("stream"))
)
def test_no_cross_join(spark, name):
    text = plan_text(entry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
