import pytest

import __spark_entry__ as registry
from tests.compare import differences
from tickloom.llm.oracle import ORACLE
from tickloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert QUERIES.keys() <= registry.queries().keys() and "pipeline" in registry.queries()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name):
    assert differences(spark, QUERIES[name], ORACLE[name], FOLDER) == []
