from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parents[1])]

from dayfold.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8,
        app="tests",
        spark__checkpoint__dir=f"file:{tmp_path_factory.mktemp('shared')}",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__default__parallelism="8",
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def settings(spark):
    """Change session settings for one test."""
    before = {}

    def change(**values: str) -> None:
        for name, value in values.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def plan_of(df) -> str:
    """The physical plan as ``explain`` prints it; the final one once ``df`` has been collected."""
    import contextlib
    import io

    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue().split("== Initial Plan ==")[0]


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(map(_rank, r)))


def _rank(value):
    return (value is not None, str(type(value)), value if value is not None else 0)
