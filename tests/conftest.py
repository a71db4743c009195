import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from quarryline.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def built(spark, sf_dir):
    """Queries by name as DataFrames, each built once: building some of them fits models."""
    import __spark_entry__ as driver

    queries, done = driver.queries(), {}

    def build(name):
        if name not in done:
            done[name] = queries[name](spark, sf_dir)
        return done[name]

    return build
