import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from roadevents.schema import EVENT_SCHEMA, RAW_SCHEMA  # noqa: E402
from roadevents.session import build_session  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        spark__master="local[4]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def path(tmp_path):
    """A folder path that does not exist yet."""
    return str(tmp_path / "out")


@pytest.fixture
def events(spark):
    """Typed events from partial rows; absent fields are null."""
    return lambda *rows, schema=EVENT_SCHEMA: spark.createDataFrame(
        [tuple(r.get(f) for f in schema.names) for r in rows], schema
    )


@pytest.fixture
def raw(events):
    return lambda *rows, schema=RAW_SCHEMA: events(*rows, schema=schema)
