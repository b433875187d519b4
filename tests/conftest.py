import pytest

from holdfast.plans.warehouse import open_warehouse
from holdfast.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 4, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def wh(spark):
    return open_warehouse(spark, SMALL)


@pytest.fixture(scope="session")
def raw(spark):
    from holdfast.sources.fixture import raw_subscribers

    return raw_subscribers(spark, SMALL).persist()
