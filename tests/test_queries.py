"""Every registered query beside its SQL on the smallest tables; the model queries train, so they are run by the driver."""

import os

import pytest
from check_oracle import compare, connect

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
MODEL = {n for n in entry.queries() if n.startswith("model_") and n != "model_inputs"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not found")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql())))
def test_query_equals_its_sql(spark, con, name):
    ok, _, difference = compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF_DIR)
    assert ok, difference


def test_every_sql_has_a_query_and_plain_types(con):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    plain = {"VARCHAR", "BIGINT", "DOUBLE", "BOOLEAN"}
    for name, sql in entry.oracle_sql().items():
        types = {str(r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
        assert types <= plain, (name, types)


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns[:2] == ["txn_id", "timestamp"] and not rows.isEmpty()
