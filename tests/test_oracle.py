"""Every registered query against its SQL on an independent engine."""

import pytest

import __spark_entry__ as contract
import oracle
from support import canonical, duck, rows_of

#: The training-data queries have tests of their own.
QUERIES = {n: q for n, q in contract.queries().items() if n not in contract.training_queries()}


@pytest.fixture(scope="module")
def sql(small):
    connection = duck(small)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle.statements())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, small, sql, name):
    df = QUERIES[name](spark, small)
    result = sql.execute(oracle.statements()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical(df.columns, rows_of(df)) == canonical(columns, result.fetchall())


def test_entry(spark):
    assert contract.entry(spark).columns == ["sale_date", "so_ve", "doanh_thu", "doanh_thu_ngay_truoc", "tang_giam"]


@pytest.mark.parametrize("name", ["summary", "revenue_daily_v1", "customer_age", "top_films", "popcorn", "revenue_dedup",
                                  "popcorn_corr", "cohort_retention", "weekend_v1"])
def test_same_rows_without_broadcast(spark, small, sql, conf, name):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions="13")
    df = QUERIES[name](spark, small)
    result = sql.execute(oracle.statements()[name])
    assert canonical(df.columns, rows_of(df)) == canonical([c[0] for c in result.description], result.fetchall())
