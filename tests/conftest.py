from __future__ import annotations

import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from tallyrow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(4, 4)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def conf(spark):
    """Sets session options for one test."""
    before = {}

    def set_options(**options):
        for name, value in options.items():
            name = name.replace("__", ".")
            before[name] = spark.conf.get(name, None)
            spark.conf.set(name, value)

    yield set_options
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture
def instructions(spark):
    rows = [
        (0, "A", "", "B"),
        (1, "A", None, "B"),
        (2, "Name the capital", "Of Norway", "Oslo"),
        (3, 'é 日本 "q"', "line\n\ttab", "ü\\n"),
    ]
    return spark.createDataFrame(rows, "row_id bigint, instruction string, input string, output string")
