import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lotwise.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate a column over literal values: one(fn, a, b) -> result."""
    from pyspark.sql import functions as F

    def run(fn, *values):
        return spark.range(1).select(fn(*[v if hasattr(v, "_jc") else F.lit(v) for v in values]).alias("x")).first().x
    return run


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())
