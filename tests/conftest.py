from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from lexitally import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    found = session.start("tests", "local[4]", spark__sql__shuffle__partitions="4",
                          spark__ui__showConsoleProgress="false", spark__driver__memory="4g",
                          spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    found.sparkContext.setLogLevel("ERROR")
    yield found
    found.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
