import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from roadpulse.session import build_session

    session = build_session(
        "tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture
def split_groups(spark):
    """Settings under which every key counts as oversized and blocks are tiny."""
    tiny = {"roadpulse.maxGroupRows": "3", "roadpulse.blockRows": "25", "roadpulse.quantileRows": "6", "roadpulse.quantileSketch": "8"}
    for key, value in tiny.items():
        spark.conf.set(key, value)
    yield
    for key in tiny:
        spark.conf.unset(key)


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""

    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect
