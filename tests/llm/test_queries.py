"""The registered queries against their SQL on the smallest driver tables."""

from __future__ import annotations

import pytest

from tests.test_queries import compare, connection  # noqa: F401
from tidemark.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, connection, sf, name):  # noqa: F811
    compare(spark, connection, QUERIES[name], ORACLES[name], sf)


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
