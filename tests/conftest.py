import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from millrace.session import build_session  # noqa: E402
from support import SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests", "local[8]", log_level="ERROR",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
           "spark.sql.warehouse.dir": str(base / "warehouse"),
           "spark.checkpoint.dir": str(base / "shared")})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SMALL
