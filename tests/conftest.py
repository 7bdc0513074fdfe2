import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fleethazard.session import build_session, clean_tables, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("local[4]", **{
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    clean_tables(session)
    session.stop()


@pytest.fixture
def fleet(spark):
    """fleet({engine: [value, ...]}) -> (engine_id, cycle, sensor_1), cycles from 1."""

    def make(values, start=1):
        rows = [(e, i, float(v) if v is not None else None) for e, xs in values.items() for i, v in enumerate(xs, start)]
        return spark.createDataFrame(rows, "engine_id long, cycle long, sensor_1 double")

    return make


@pytest.fixture
def scores(spark):
    def make(y, p):
        rows = [(1, i + 1, int(a), float(b)) for i, (a, b) in enumerate(zip(y, p))]
        return spark.createDataFrame(rows, "engine_id long, cycle long, label int, y_proba double")

    return make
