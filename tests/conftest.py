import pytest

from tesselon.session import get_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(4, **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
