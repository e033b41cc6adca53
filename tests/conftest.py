import pytest

from evigrade.session import build


@pytest.fixture(scope="session")
def spark():
    session = build(shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
