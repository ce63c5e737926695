import pytest

from tests.oracle import make_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = make_session("4", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()
