import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from atlasmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("4", "tests", **{"spark.driver.memory": "4g", "spark.sql.shuffle.partitions": "4"})
    entry.ship(s)
    yield s
    s.stop()
