import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from millrace.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="8", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """DataFrame from rows and a DDL schema."""
    return lambda ddl, *rows: spark.createDataFrame(list(rows), ddl)


def rows(df, *columns):
    """Sorted tuples of the columns (nulls first)."""
    found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda r: [(v is not None, str(type(v)), v) for v in r])
