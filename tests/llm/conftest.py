"""Small frames for the operators of the subpackage."""

import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """A frame from rows and a schema, in several partitions."""

    def make(rows, schema, partitions=3):
        return spark.createDataFrame(rows, schema).repartition(partitions)

    return make
