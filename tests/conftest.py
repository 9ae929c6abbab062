import pytest

from provatab.cluster import session


@pytest.fixture(scope="session")
def spark():
    s = session("provatab-tests", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
