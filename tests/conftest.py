from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from postings.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("postings-tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.log.level": "ERROR",
    })
    yield session
    session.stop()
