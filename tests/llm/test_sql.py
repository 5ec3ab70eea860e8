import pytest

import __spark_entry__ as entry
from lakeops.llm.queries import ORACLE

from compare import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_gives_what_its_sql_gives(spark, name):
    assert entry.oracle_sql()[name] == ORACLE[name]
    problem = difference(entry.queries()[name](spark, FOLDER), connect(FOLDER), ORACLE[name])
    assert problem is None, problem
