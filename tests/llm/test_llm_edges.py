"""No training-data query fails on empty tables or on rows of nulls, and neither has a case in them."""

import pytest

from edges import write
from stratalog.llm.queries import QUERIES


@pytest.fixture(scope="module", params=["empty", "nulls"])
def edge(request, data, tmp_path_factory):
    return write(data, str(tmp_path_factory.mktemp(request.param)), request.param)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, edge):
    rows = QUERIES[name](spark, edge).collect()
    if name.endswith("_found"):
        assert rows == []
