import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(os.path.dirname(HERE)), os.path.dirname(HERE), HERE]

from samples import EDGE, SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def edge(spark):
    """The edge rows, with extra columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(EDGE, SCHEMA)
    return df.withColumns({c: F.lit("x") for c in ("score", "label", "ids", "language", "n", "key", "stats", "rules", "evidence")})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
