import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from tidemark import build_session

    session = build_session(
        "tests",
        "local[*]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="6g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="tidemark-tests-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
