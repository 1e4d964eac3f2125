"""One local session for all tests."""

from __future__ import annotations

import pytest

from mergelens.session import build_session

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(shared),
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """Collected rows as tuples, sorted."""
    chosen = df.select(*order) if order else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
