import pytest

from dumpmill.llm.queries import ORACLES, QUERIES
from tests.test_queries import compare, con  # noqa: F401  the fixture


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, sf_dir, name):  # noqa: F811
    compare(QUERIES[name](spark, sf_dir), con, ORACLES[name])
