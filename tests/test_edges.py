"""No core query fails on empty tables or on rows of nulls."""

import pytest

import __spark_entry__ as entry
from edges import write

QUERIES = {k: f for m in entry._modules() if not m.__name__.startswith("stratalog.llm") for k, f in m.QUERIES.items()}


@pytest.fixture(scope="module", params=["empty", "nulls"])
def edge(request, data, tmp_path_factory):
    return write(data, str(tmp_path_factory.mktemp(request.param)), request.param)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, edge):
    QUERIES[name](spark, edge).collect()
