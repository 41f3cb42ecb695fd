from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from tillwork.session import open_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = open_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples, NULLs first."""

    def sorted_rows(df, *columns):
        found = [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
        return sorted(found, key=lambda row: [(value is not None, str(value)) for value in row])

    return sorted_rows
