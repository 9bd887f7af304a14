import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from tallystar.session import build

    session = build(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.default.parallelism": "2",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
