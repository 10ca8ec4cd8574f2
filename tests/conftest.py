import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from demandspark.session import get_session

    s = get_session("local[4]", 8)
    yield s


def fact_rows(spark, rows, cols=None):
    """Build a small fact DataFrame from tuples in FACT_SCHEMA order."""
    from demandspark import schema as S

    schema = S.FACT_SCHEMA if cols is None else cols
    return spark.createDataFrame(rows, schema)
