import pytest

from gridloom.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("local[4]", 4, **{"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")), "spark.driver.memory": "6g"})
    yield session
    session.stop()
