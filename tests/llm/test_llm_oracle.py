"""Every registered query with SQL against it; the others run."""

import pytest
from oracle import DATA, connect, differences

from millrace.llm.queries import LLM_QUERIES

SF_DIR = str(DATA / "sf0.001")


@pytest.mark.parametrize("name", sorted(LLM_QUERIES))
def test_query(spark, name):
    query = LLM_QUERIES[name]
    result = query.run(spark, SF_DIR)
    if query.oracle is None:
        assert result.count() > 0
    else:
        assert differences(result, connect(SF_DIR), query.oracle) == []


def test_names_are_the_contract():
    assert sorted(int(n.split("_")[0][2:]) for n in LLM_QUERIES) == list(range(1, 14))
