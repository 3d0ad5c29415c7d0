import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from rankloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("8", spark__sql__shuffle__partitions="4")


@pytest.fixture
def small_groups(spark):
    """Treat every group of more than 5 rows as too large for one task."""
    spark.conf.set("rankloom.groupRows", "5")
    yield
    spark.conf.unset("rankloom.groupRows")
