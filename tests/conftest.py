import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from skytally.schemas import SNAPSHOT  # noqa: E402
from skytally.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    """Paths below a fresh folder, as text."""
    return lambda *parts: str(tmp_path.joinpath(*parts))


def aircraft(**fields):
    """One aircraft as the receiver sends it; what is not given is missing."""
    known = SNAPSHOT["aircraft"].dataType.elementType.names
    assert set(fields) <= set(known)
    return {name: fields.get(name) for name in known}


def snapshots(spark, rows):
    """Snapshots from (receiver, arrival, now, aircraft list) tuples."""
    data = [(r, float(a), float(n), 0, craft) for r, a, n, craft in rows]
    return spark.createDataFrame(data, SNAPSHOT)


def values(frame, *columns):
    """Rows as a sorted list of tuples."""
    rows = [tuple(row) for row in (frame.select(*columns) if columns else frame).collect()]
    return sorted(rows, key=lambda r: [(v is None, v) for v in r])


def plan(frame):
    """The physical plan as text, before it runs."""
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
