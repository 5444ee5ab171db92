from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tidehouse.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    extra = {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "6g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    session = build_session("tests", "local[4]", extra)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
