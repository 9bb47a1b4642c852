import pytest

from sonorum.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(cpus=4, shuffle_partitions=4)
