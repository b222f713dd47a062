"""Shared session and folders."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyfield import build_session  # noqa: E402

TESTDATA = os.environ.get("TALLYFIELD_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", master="local[*]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="session")
def small_sf():
    return f"{TESTDATA}/sf0.001"
