"""Every registered query against its DuckDB oracle on sf0.01."""

import pytest

import __spark_entry__ as E
from snapmart.plans import catalog
from tests.conftest import SF001
from tests.oracle_util import compare


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_oracle(spark, name):
    r = compare(spark, name, SF001)
    assert not r["problems"], r


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["title", "video_id", "channel_id", "views_count"]
    assert df.count() >= 0
