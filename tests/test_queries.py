"""Every registered query against its SQL equivalent, and the shape of the main plans."""

import glob
import os
import re

import pytest

import __spark_entry__ as entry_module
from marketloom import catalog, oracles
from marketloom.operators import calendar
from marketloom.sources import sample

QUERIES, ORACLES = catalog.QUERIES, oracles.ORACLES


@pytest.fixture(scope="module")
def duck(sf_dir):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _text(value):
    if value is None or value != value:
        return "NULL"
    if hasattr(value, "year"):
        return str(value)[:10]
    if type(value).__name__ in ("bool", "bool_"):
        return str(bool(value))
    return repr(float(value)) if isinstance(value, float) else str(value)


def _rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted(
        tuple(_text(v) for v in row) for row in frame[columns].itertuples(index=False, name=None)
    )


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry_module.queries().items()
    assert ORACLES.items() <= entry_module.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    got = _rows(QUERIES[name](spark, sf_dir).toPandas())
    expected = _rows(duck.execute(ORACLES[name]).fetchdf())
    assert got[0] == expected[0]
    assert got[1] == expected[1]


def test_entry(spark):
    assert entry_module.entry(spark).columns[:2] == ["portfolio_name", "date_key"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_asset_fact_plan(spark, sf_dir):
    fact = catalog._wide_fact(spark, sf_dir)
    plan = _plan(fact)
    assert "Python" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # Only the FX series goes through one partition; prices are spread by symbol.
    assert re.search(r"hashpartitioning\(symbol#\d+, 8\), REPARTITION_BY_NUM", plan)
    assert re.search(r"ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:", plan)
    # No window runs over the expanded rows: none stands above the first Generate.
    top_generate = plan.index("Generate explode(sequence(price_date")
    assert "Window" not in plan[:top_generate]


def test_fill_needs_no_join(spark, sf_dir):
    prices = sample.customer_prices(spark, sf_dir)
    filled = calendar.fill_prices(prices, calendar.dim_date(sample.price_days(spark, sf_dir)))
    assert "Join" not in _plan(filled)


def test_filters_reach_the_scan(spark, sf_dir, tmp_path):
    from marketloom.operators import moments

    catalog._fact(spark, sf_dir).write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    plan = _plan(moments.complete_returns(fact, sample.SYMBOLS[:2], *catalog.RANGE))
    assert "In(symbol, [1-URGENT,2-HIGH])" in plan
    assert "GreaterThanOrEqual(" in plan.split("PushedFilters: ")[1]
    assert "ReadSchema: struct<symbol:string,date_key:date,daily_return:double>" in plan


@pytest.mark.parametrize(
    "name", ["portfolio_summary_wide", "validate_struct_records", "raw_array_records"]
)
def test_no_python_in_plans(spark, sf_dir, name):
    plan = _plan(QUERIES[name](spark, sf_dir))
    assert "Python" not in plan and "CartesianProduct" not in plan
