import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from editpulse.session import build_session  # noqa: E402
from editpulse.sources.lake import Lake  # noqa: E402

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_sf():
    return str(TESTDATA / "sf0.001")


@pytest.fixture(scope="session")
def oracle_sf():
    return str(TESTDATA / "sf0.01")


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))
