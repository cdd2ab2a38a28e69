import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from larkspur.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        app="larkspur-tests",
        master="local[4]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("scratch")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def events(spark):
    """(user, at, id): user 7 owns a third of the rows, user None some."""
    rows = [(u, at, u * 1000 + at) for u in range(1, 7) for at in range(20 * u)]
    rows += [(7, at, 7000 + at) for at in range(260)]
    rows += [(None, at, 9000 + at) for at in range(90)]
    return spark.createDataFrame(rows, "user bigint, at int, id bigint").repartition(5, "id")
