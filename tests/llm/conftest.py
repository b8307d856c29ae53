import pytest


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from crewspark.llm.common import ship_package

    ship_package(spark)


@pytest.fixture
def frame(spark):
    """A DataFrame of rows over a few partitions."""
    def make(rows, schema, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)
    return make
