import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cornerstore.session import build_session, drop_intermediate  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "cornerstore-tests",
        master=os.environ.get("TEST_MASTER", "local[8]"),
        shuffle_partitions=8,
        settings={
            "spark.driver.memory": "8g", "spark.sql.warehouse.dir": "/tmp/cornerstore-warehouse",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="cornerstore-tests-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_intermediate(session)
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
