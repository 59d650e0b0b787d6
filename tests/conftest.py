import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from shelfcast.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(cpus="8", app="shelfcast-tests")


@pytest.fixture
def frame(spark):
    """Rows and a DDL schema to a DataFrame."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def column(df, *names):
    return [tuple(r[n] for n in names) if len(names) > 1 else r[names[0]] for r in df.collect()]
