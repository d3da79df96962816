import pytest


@pytest.fixture(scope="session")
def spark():
    from ringsight.session import local_session

    return local_session(8, "ringsight-tests")
