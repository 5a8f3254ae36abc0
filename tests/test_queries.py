"""Every query of the library's own operators against its SQL on a second engine."""

import pytest
from oracle_check import connect, difference

import __spark_entry__ as entry_points
from tidemark.plans import oracle, registry, streams

# Whatever else is registered is tested by its own package.
QUERIES, SQL = {**registry.BATCH, **streams.STREAMS}, {**oracle.BATCH, **oracle.STREAMS}


@pytest.fixture(scope="module")
def small(sf_small):
    return connect(sf_small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, sf_small, small, name):
    assert difference(QUERIES[name](spark, sf_small), small, SQL[name]) is None


def test_every_query_but_the_sketch_has_sql():
    assert set(QUERIES) - set(SQL) == {"uv_hourly_approx"}
    assert set(SQL) <= set(QUERIES)
    assert QUERIES.items() <= entry_points.queries().items()
    assert SQL.items() <= entry_points.oracle_sql().items()


def test_sketch_has_the_windows_of_the_exact_count(spark, sf_small):
    approx = {r.window_end: r.uv_count for r in QUERIES["uv_hourly_approx"](spark, sf_small).collect()}
    exact = {r.window_end: r["count"] for r in QUERIES["uv_hourly"](spark, sf_small).collect()}
    assert approx.keys() == exact.keys()
    assert all(abs(approx[w] - exact[w]) <= max(1, 0.1 * exact[w]) for w in exact)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["window_end", "rank", "item_id", "view_count"]
    assert df.count() > 0
