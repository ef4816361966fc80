import pytest

from ledgerloom.plans.warehouse import Warehouse
from ledgerloom.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("ledgerloom-tests", cores="4", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def warehouse(spark, tmp_path):
    database = f"wh_{tmp_path.name}".replace("-", "_")
    return Warehouse(spark, str(tmp_path / "wh"), database, range_size=10)
