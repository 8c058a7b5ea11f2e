"""Queries of the operators against SQL where SQL can say the same."""

import pytest

from marketloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    got = queries.QUERIES[name](spark, sf_dir)
    expected = duck.execute(queries.ORACLES[name])
    names = [column[0] for column in expected.description]
    assert sorted(got.columns) == sorted(names)

    def rows(found):
        return sorted(tuple(map(str, row)) for row in found)

    assert rows(got.select(*names).collect()) == rows(expected.fetchall())


def test_every_operator_has_a_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize("name", ["op7_pii_patterns", "op9_chat_schema"])
def test_native_plans(spark, sf_dir, name):
    plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
