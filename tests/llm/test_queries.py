"""The registered queries of this subpackage on the smallest tables, against their SQL."""

from pathlib import Path

import pytest
from compare import connect, differences

from tidewell.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    if not Path(SF).exists():
        pytest.skip("no test tables here")
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in SQL:
        assert differences(df, con, SQL[name]) is None
    else:
        assert df.count() >= 0
