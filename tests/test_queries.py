"""Every query of the library's own operators beside its SQL, on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from compare import difference, expected  # noqa: E402

import ledgerlens.queries as own  # noqa: E402


@pytest.mark.parametrize("name", own.QUERIES)
def test_query(spark, sf_dir, name):
    got = own.QUERIES[name](spark, sf_dir).toArrow()
    assert got.num_rows or name in ("q43_embedding_queue",)
    if name in own.SQL:
        assert difference(got, expected(sf_dir, own.SQL[name])) == ""
