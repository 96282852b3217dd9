import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rawgate import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]",
        "tests",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="6g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def landing(tmp_path):
    """Writes text files into a folder and returns the folder."""

    def write(**files):
        for name, text in files.items():
            data = text if isinstance(text, bytes) else text.encode()
            (tmp_path / name.replace("__", ".")).write_bytes(data)
        return str(tmp_path)

    return write
