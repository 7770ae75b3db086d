import pytest
from oracle_compare import connect, differences

from tallyward.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, folder, name):
    assert differences(QUERIES[name](spark, folder), connect(folder), ORACLE[name]) is None
