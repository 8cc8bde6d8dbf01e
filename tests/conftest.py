import pytest

from cratemark.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    """The session that ships; only cores, memory and scratch are those of a test."""
    session = build_session(
        "tests",
        spark__master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
