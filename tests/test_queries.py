"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from compare import TABLES, canonical

FOLDER = "/root/testdata/sf0.001"
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


def test_every_sql_has_a_query():
    assert set(SQL) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    got = contract.queries()[name](spark, FOLDER).toPandas()
    want = con.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_entry(spark):
    assert contract.entry(spark).columns == ["guid", "productId", "sourceId", "signalDate"]


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(SQL)))
def test_queries_without_sql_run(spark, name):
    assert contract.queries()[name](spark, FOLDER).count() > 0


@pytest.mark.parametrize("name", ["als_similar_items"])
def test_searches_ask_for_every_hundredth_row(spark, name):
    asked = {r.id for r in contract.queries()[name](spark, FOLDER).select("id").distinct().collect()}
    assert asked and all(i % 100 == 0 for i in asked)


def test_every_user_gets_items_and_brands(spark):
    users = {r.id for r in contract.queries()["user_vector_lookup"](spark, FOLDER).select("id").collect()}
    for name in ("user_top_items", "user_top_brands"):
        asked = {r.id for r in contract.queries()[name](spark, FOLDER).select("id").distinct().collect()}
        assert users <= asked and any(i % 100 for i in asked)


def test_every_item_gets_similar_items(spark):
    found = contract.queries()["approx_similar_items"](spark, FOLDER)
    items = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    assert {r.id for r in found.select("id").distinct().collect()} == {r.vec_id for r in items.select("vec_id").collect()}
