"""The search of weights as rounds over rows, against the search of one problem in numpy."""

from types import SimpleNamespace

import numpy as np
import pytest
from numpy_search import Problem
from pyspark.sql import functions as F

from marketloom.operators import allocate

SCHEMA = (
    "id int, annual_returns array<double>, annual_covariances array<array<double>>, "
    "upper_bounds array<double>, is_crypto array<boolean>, start_weights array<double>"
)


def problem(seed, n, caps=(0.6, 0.15)):
    rng = np.random.default_rng(seed)
    factors = rng.normal(size=(n, 3))
    covariances = factors @ factors.T * 0.02 + np.diag(rng.uniform(0.01, 0.1, n))
    crypto = [i % 4 == 3 for i in range(n)]
    return SimpleNamespace(
        annual_returns=rng.uniform(-0.1, 0.4, n).tolist(),
        annual_covariances=covariances.tolist(),
        upper_bounds=[caps[c] for c in crypto],
        is_crypto=crypto,
    )


def asked(spark, problems):
    rows = [(k, *vars(p).values(), None) for k, p in enumerate(problems)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("rate", [0.04, 0.9], ids=["ascent", "corners"])
def test_rounds_reach_what_numpy_reaches(spark, monkeypatch, rate):
    # Few moves a round, so that rows need several rounds and end in different ones.
    monkeypatch.setattr(allocate, "MOVES", 15)
    problems = [problem(k, n) for k, n in enumerate([3, 5, 12, 20])]
    got = allocate.optimize(asked(spark, problems), ["id"], rate, 0.25).collect()
    assert len(got) == len(problems)
    for row in got:
        by_hand = Problem(problems[row.id], rate, 0.25)
        found, best = np.array(row.weights), by_hand.solve([])
        assert abs(found.sum() - 1) < 1e-9 and (found >= -1e-12).all()
        assert (found <= by_hand.caps + 1e-9).all()
        assert found[by_hand.crypto].sum() <= 0.25 + 1e-9
        assert by_hand.sharpe(found) == pytest.approx(by_hand.sharpe(best), abs=1e-9)


def test_problems_without_an_answer(spark):
    narrow, flat = problem(1, 4, caps=(0.2, 0.1)), problem(2, 4)
    flat.annual_covariances = np.zeros((4, 4)).tolist()
    unknown = SimpleNamespace(
        annual_returns=None, annual_covariances=None, upper_bounds=[0.6], is_crypto=[False]
    )
    rows = asked(spark, [narrow, flat, unknown])
    assert [r.weights for r in allocate.optimize(rows, ["id"]).collect()] == [None] * 3
    assert allocate.optimize(rows.filter("false"), ["id"]).collect() == []


def test_no_python_and_starts_on_many_tasks(spark, monkeypatch):
    written = {}
    stored = allocate.stored

    def watched(df, purpose):
        written.setdefault(purpose, []).append(df)
        return stored(df, purpose)

    monkeypatch.setattr(allocate, "stored", watched)
    allocate.optimize(asked(spark, [problem(3, 12)]), ["id"], 0.9, 0.25).collect()
    for df in [frame for frames in written.values() for frame in frames]:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    corners = written["weight-search"][0]
    tasks = corners.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in tasks) == 13 and len(tasks) > 3


def test_rolling_covariances(spark):
    from datetime import date, timedelta

    from marketloom.operators import moments

    rng = np.random.default_rng(4)
    values = {"A.X": rng.normal(size=40), "B": rng.normal(size=40) + 5, "C": rng.normal(size=40)}
    rows = [
        ("one", s, date(2026, 1, 1) + timedelta(k), float(x))
        for s, xs in values.items() for k, x in enumerate(xs) if not (s == "B" and k == 17)
    ] + [("short", "A.X", date(2026, 1, 1), 0.5), ("short", "A.X", date(2026, 1, 2), None)]
    frame = spark.createDataFrame(rows, "name string, symbol string, date_key date, daily_return double")
    got = moments.rolling_covariances(frame, ["name"], 10, 365).collect()
    days = [k for k in range(40) if k != 17]
    assert len(got) == (len(days) - 9) * 6
    for r in got:
        end = days.index((r.date_key - date(2026, 1, 1)).days)
        window = days[end - 9 : end + 1]
        expected = np.cov(values[r.symbol_i][window], values[r.symbol_j][window])[0, 1] * 365
        assert r.annual_covariance == pytest.approx(expected, abs=1e-9)


def test_states_are_written_without_moments(spark, monkeypatch):
    """Moments of n symbols in each of n starts filled the disk."""
    written, stored = [], allocate.stored

    def watched(df, purpose):
        written.append((purpose, df.columns))
        return stored(df, purpose)

    monkeypatch.setattr(allocate, "stored", watched)
    rows = asked(spark, [problem(3, 12)])
    (row,) = allocate.optimize(rows, ["id"], 0.9, 0.25).collect()
    assert abs(sum(row.weights) - 1) < 1e-9
    searched = [columns for purpose, columns in written if purpose == "weight-search"]
    assert len(searched) >= 2
    assert all(columns == ["_problem", "_number", "_state"] for columns in searched)
