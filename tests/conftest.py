import pytest

from sparkloom import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session("local[4]", app="tests", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
