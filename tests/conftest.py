import pytest

from tamiz.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """rows(schema, data, partitions): a small table."""

    def make(schema, data, partitions=None):
        df = spark.createDataFrame(data, schema)
        return df if partitions is None else df.repartition(partitions)

    return make


def collected(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]
