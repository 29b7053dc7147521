import pytest
from oracle import same

from sievewright.llm import registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_sql(spark, name):
    same(spark, registry.queries()[name], registry.oracle_sql()[name], "/root/testdata/sf0.01")
