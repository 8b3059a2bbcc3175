import inspect

import oracle
import pytest

import __spark_entry__ as entry_points
from starflow.catalog import oracles, queries
from starflow.sources.flat_sales import ORDER_KEY, flat_sales
from starflow.sources.workspace import Workspace

QUERIES = queries.QUERIES
ORACLES = oracles.ORACLES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = oracle.connect(sf_dir)
    yield con
    con.close()


@pytest.fixture(scope="module")
def stored_extract(spark, sf_dir, tmp_path_factory):
    place = Workspace(spark, str(tmp_path_factory.mktemp("extract")))
    return place.store(flat_sales(spark, sf_dir, order_key=True), "flat")


@pytest.fixture
def shared_extract(monkeypatch, stored_extract):
    """The flat extract is joined once for all queries, not once per query."""

    def stored(spark, sf_dir, order_key=False):
        return stored_extract if order_key else stored_extract.drop(ORDER_KEY)

    monkeypatch.setattr(queries, "flat_sales", stored)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert all(len(inspect.signature(q).parameters) == 2 for q in QUERIES.values())


def test_entry_points_hold_the_catalogue():
    assert QUERIES.items() <= entry_points.queries().items()
    assert ORACLES.items() <= entry_points.oracle_sql().items()


def test_flat_extract_equals_sql(spark, sf_dir, duck):
    sql = oracles.ON_FLAT + "SELECT * FROM keyed"
    assert oracle.compare(flat_sales(spark, sf_dir, order_key=True), duck, sql) == []


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, sf_dir, duck, shared_extract, name):
    assert oracle.compare(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) == []


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["category", "quarter", "value_sales", "units_sales", "price_per_unit"]
    assert df.count() > 0
