import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

from roadpulse.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SMALL):
        pytest.skip("test tables are not here")
    return SMALL


@pytest.fixture
def make_reports(spark):
    """Reports from (time, vid, spd, xway, dir, seg, pos) tuples in arrival order."""

    def make(rows):
        full = [(t, v, s, x, 0, d, g, p, i) for i, (t, v, s, x, d, g, p) in enumerate(rows)]
        return spark.createDataFrame(
            full,
            "time int, vid int, spd int, xway int, lane int, dir int, seg int, pos int, seq long",
        )

    return make


@pytest.fixture
def make_sensor(spark):
    def make(rows):
        return spark.createDataFrame(
            [(*r, i) for i, r in enumerate(rows)], "ts long, id string, value double, seq long"
        )

    return make


def rows(df):
    return sorted(tuple(r) for r in df.collect())
