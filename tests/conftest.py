from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from skymeter.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def collected():
    """Rows as a sorted list of tuples, NULL first."""

    def collect(df, *columns):
        rows = df.select(*columns).collect() if columns else df.collect()
        return sorted((tuple(r) for r in rows), key=lambda r: [(v is not None, v) for v in r])

    return collect
