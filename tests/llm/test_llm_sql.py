"""Every operator query with SQL gives the rows of DuckDB; a second run gives the same rows."""

import pytest
from compare import connect, difference, rows

from quarryline.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, sf_dir, db, name):
    assert difference(QUERIES[name](spark, sf_dir), db, ORACLES[name]) is None


@pytest.mark.parametrize("name", ["op5_nearest_centroid", "op9_association_rules", "op10_partenum"])
def test_reruns_agree(spark, sf_dir, name):
    first, second = (QUERIES[name](spark, sf_dir) for _ in range(2))
    assert rows(first.columns, first.collect()) == rows(second.columns, second.collect())
