import pytest

from tracehouse.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, "tests")
    yield session
    session.stop()
