import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from gaugeworks.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[4]",
        app="gaugeworks-tests",
        spark__sql__shuffle__partitions=3,
        spark__default__parallelism=3,
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("work")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return lambda name: str(tmp_path / name)


READING = (
    "city_id STRING, poll_timestamp TIMESTAMP, temp DOUBLE, humidity INT, aqi INT, pm2_5 DOUBLE, pm10 DOUBLE"
)


@pytest.fixture
def readings(spark):
    """Rows of (city, time, temp, aqi) as readings."""

    def make(rows):
        full = [(c, t, temp, 50, aqi, 1.0, 2.0) for c, t, temp, aqi in rows]
        return spark.createDataFrame(full, READING)

    return make
