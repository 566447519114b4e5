import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from fieldwise.session import checkpoint_dir, local_session

    s = local_session(cores=8, app="fieldwise-tests")
    checkpoint_dir(s)
    yield s


def one(spark, expr, schema, values):
    """Evaluate a Column over literal rows; returns the list of results."""
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr).collect()]
