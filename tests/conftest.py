import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from creditmart.session import get_session, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests",
        spark__master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    shared_dir(session)
    yield session
    session.stop()
