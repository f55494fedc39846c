import os

import pytest

from corpuskit.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def column(spark):
    """Values of a column function applied to each of some strings."""

    def run(function, values):
        from pyspark.sql import functions as F

        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "i int, v string").repartition(2)
        return [r.out for r in df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]

    return run
