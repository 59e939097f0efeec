import pytest

from termloom.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return local_session(8, "termloom-tests", scratch=str(tmp_path_factory.mktemp("scratch")))
