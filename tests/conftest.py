import pytest

from fleetlake.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
