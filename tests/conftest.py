import pytest

from corpusmill.session import local_session


@pytest.fixture(scope="session")
def spark():
    s = local_session("tests", cores=4, shuffle_partitions=4, memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
