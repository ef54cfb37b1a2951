import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
for folder in (ROOT, ROOT / "tests"):
    if str(folder) not in sys.path:
        sys.path.insert(0, str(folder))

from municare.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    settings = {"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"}
    session = build_session("tests", "local[8]", **settings)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    from municare.session import shared_folder

    return shared_folder(spark, "test")
