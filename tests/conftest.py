import pytest

from formweave.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "formweave-tests", "4g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture()
def value(spark):
    """The value of one column expression."""

    def get(column):
        return spark.range(1).select(column).first()[0]

    return get
