import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from ordermill.schema import ORDER_SCHEMA  # noqa: E402
from ordermill.session import drop_staged, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        import tempfile

        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ordermill-tests-"))
    yield session
    drop_staged(session)


@pytest.fixture(scope="session")
def raw_orders(spark):
    """Build the raw order table from dicts of the columns that matter."""

    def build(rows):
        return spark.createDataFrame([tuple(r.get(c) for c in ORDER_SCHEMA.names) for r in rows], ORDER_SCHEMA)

    return build


def rows(df, *columns):
    """The rows of a result as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((v is not None, str(v)) for v in t))
