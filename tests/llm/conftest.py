import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def spark():
    from fieldwise.session import checkpoint_dir, local_session

    s = local_session(cores=4, app="fieldwise-llm-tests")
    checkpoint_dir(s)
    yield s


@pytest.fixture
def odd(spark):
    """Null and empty texts, one very long text, null ids, repeated rows and columns with clashing names."""

    def make(*texts):
        long = " ".join(f"w{i % 977}" for i in range(30_000))
        rows = [(1, None), (2, ""), (3, " \n\t"), (4, long), (None, "a lone row without an id"), (5, "twice"), (5, "twice")]
        rows += [(100 + i, t) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, "doc_id bigint, text string")
        from pyspark.sql import functions as F

        names = ["key", "id", "n", "row", "_text", "bucket", "hash", "kind", "owner", "score", "kept", "a", "b", "root", "item"]
        for c in names:
            df = df.withColumn(c, F.lit("x"))
        return df.withColumn("lang", F.lit("en")).withColumn("source", F.lit(None).cast("string")).withColumn("n_chars", F.length("text").cast("bigint"))

    return make


@pytest.fixture
def empty(odd):
    return odd().limit(0)
