from __future__ import annotations

import pytest

from inkprint.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", 8, spark__driver__memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
