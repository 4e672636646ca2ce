import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from castframe.session import build_session, ship  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8, spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    ship(session, "castframe", "workload")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
