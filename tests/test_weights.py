import math
import random
from datetime import date, timedelta
from types import SimpleNamespace

import numpy as np
import pytest
from numpy_search import Problem

from marketloom.operators import allocate, moments, weights
from marketloom.plans import gold

# A trend for each symbol and waves that are shared in part, so that no two move alike.
TRENDS = {"ALPHA": 3, "BETA": 5, "GAMMA": 1, "ONEUSDT": 9, "TWOUSDT": 14}
RETURNS = {
    s: [
        (t + 20 * math.sin(1.3 * k + i) + 11 * math.cos(0.7 * k * (i + 1))) / 1e4
        for k in range(24)
    ]
    for i, (s, t) in enumerate(TRENDS.items())
}
HELD = {"ALPHA": 0.3, "BETA": 0.3, "GAMMA": 0.2, "ONEUSDT": 0.1, "TWOUSDT": 0.1}
SYMBOLS = list(RETURNS)
SCHEMA = "date_key date, symbol string, daily_return double"


def fact_of(spark, returns=RETURNS):
    rows = [
        (date(2026, 1, 2) + timedelta(k), s, r) for s, rs in returns.items() for k, r in enumerate(rs)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_matrix_keeps_complete_dates_only(spark):
    d1, d2, d3 = (date(2026, 1, k) for k in (1, 2, 3))
    rows = [
        (d1, "A.X", None), (d1, "CUSDT", 0.1),
        (d2, "A.X", 0.01), (d2, "CUSDT", 0.02), (d2, "OTHER", 0.5),
        (d3, "A.X", 0.03),
    ]
    fact = spark.createDataFrame(rows, SCHEMA)
    matrix = moments.return_matrix(fact, ["A.X", "CUSDT"])
    assert matrix.columns == ["date_key", "A.X", "CUSDT"]
    assert [tuple(r) for r in matrix.collect()] == [(d2, 0.01, 0.02)]
    assert moments.return_matrix(fact, ["A.X"], "2026-01-03", "2026-01-03").count() == 1
    with pytest.raises(ValueError, match="one symbol or more"):
        moments.return_matrix(fact, [])


def test_moments_equal_numpy(spark):
    matrix = moments.complete_returns(fact_of(spark), SYMBOLS)
    row = moments.moments(matrix, SYMBOLS).first()
    values = np.array([RETURNS[s] for s in SYMBOLS])
    assert row["annual_returns"] == pytest.approx(list(values.mean(axis=1) * 365))
    assert np.allclose(np.array(row["annual_covariances"]), np.cov(values) * 365)
    assert row["observation_count"] == 24
    assert row["lookback_end_date"] == date(2026, 1, 25)
    assert moments.annual_covariances(matrix, SYMBOLS).count() == 25
    fact = fact_of(spark).selectExpr("*", "'all' AS name")
    (group,) = moments.grouped(fact, ["name"]).collect()
    assert (group.symbols, group.observation_count) == (SYMBOLS, 24)
    assert group.annual_returns == pytest.approx(row["annual_returns"])
    assert np.allclose(np.array(group.annual_covariances), np.array(row["annual_covariances"]))


@pytest.mark.parametrize("n", [5, 200])
def test_covariances_take_one_pass_for_any_number_of_symbols(spark, n):
    rng = np.random.default_rng(n)
    values = rng.normal(size=(30, n))
    names = [f"S{i:03}" for i in range(n)]
    rows = [(date(2026, 1, 1) + timedelta(k), *map(float, v)) for k, v in enumerate(values)]
    schema = ", ".join(["date_key date", *(f"{s} double" for s in names)])
    matrix = spark.createDataFrame(rows, schema)
    found = moments.moments(matrix, names)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate posexplode") == 1 and "Union" not in plan
    assert np.allclose(np.array(found.first()["annual_covariances"]), np.cov(values.T) * 365)


def test_score(spark):
    known = spark.createDataFrame(
        [([0.3, 0.06], [[0.16, 0.02], [0.02, 0.01]])],
        "annual_returns array<double>, annual_covariances array<array<double>>",
    )
    vectors = spark.createDataFrame(
        [("a", [0.25, 0.75]), ("none", [0.0, 0.0])], "candidate_id string, weights array<double>"
    )
    scored = {r.candidate_id: r for r in weights.score(vectors, known, 0.07).collect()}
    volatility = math.sqrt(0.0625 * 0.16 + 2 * 0.1875 * 0.02 + 0.5625 * 0.01)
    assert scored["a"].annual_return == pytest.approx(0.12)
    assert scored["a"].annual_volatility == pytest.approx(volatility)
    assert scored["a"].sharpe_ratio == pytest.approx(0.05 / volatility)
    assert scored["none"].sharpe_ratio is None and scored["none"].objective == 1e9
    assert weights.best(weights.score(vectors, known, 0.07)).first().candidate_id == "a"


def test_tiny_negative_variance_is_zero(spark):
    schema = "annual_returns array<double>, annual_covariances array<array<double>>"
    vectors = spark.createDataFrame([("a", [1.0])], "candidate_id string, weights array<double>")
    for variance, volatility in [(-1e-13, 0.0), (-1e-3, None)]:
        known = spark.createDataFrame([([0.1], [[variance]])], schema)
        row = weights.score(vectors, known).first()
        assert (row.annual_volatility, row.sharpe_ratio) == (volatility, None)


def _problem(returns, covariances, crypto, single=0.6, own=0.15, total=0.25, rate=0.04):
    row = SimpleNamespace(
        annual_returns=returns,
        annual_covariances=covariances,
        upper_bounds=[own if c else single for c in crypto],
        is_crypto=crypto,
    )
    return Problem(row, rate, total)


def _random_problem(rng, n, rate):
    factors = rng.normal(size=(n, 3))
    covariances = factors @ factors.T * 0.02 + np.diag(rng.uniform(0.01, 0.1, n))
    crypto = [i % 4 == 3 for i in range(n)]
    return _problem(rng.uniform(-0.1, 0.4, n), covariances, crypto, rate=rate)


def _feasible(problem, w):
    return (
        abs(w.sum() - 1) < 1e-9
        and (w >= -1e-12).all()
        and (w <= problem.caps + 1e-9).all()
        and w[problem.crypto].sum() <= problem.crypto_total + 1e-9
    )


@pytest.mark.parametrize("n", [5, 12, 30, 60])
def test_no_move_improves_the_best_weights(spark, n):
    rng = np.random.default_rng(n)
    problem = _random_problem(rng, n, 0.04)
    best = problem.solve([])
    assert _feasible(problem, best)
    schema = (
        "annual_returns array<double>, annual_covariances array<array<double>>, "
        "is_crypto array<boolean>, upper_bounds array<double>, weights array<double>"
    )
    row = (
        problem.returns.tolist(), problem.covariances.tolist(), problem.crypto.tolist(),
        problem.caps.tolist(), best.tolist(),
    )
    worse = (*row[:4], problem.fill(range(n)).tolist())
    judged = allocate.certificates(spark.createDataFrame([row, worse], schema), 0.04).collect()
    assert all(r.within_limits for r in judged)
    assert judged[0].best_gain <= allocate.GRADIENT_TOLERANCE < judged[1].best_gain
    # Nor do random feasible weights.
    for _ in range(2000):
        other = problem.fill(rng.permutation(n))
        mixed = best + rng.uniform() ** 3 * (other - best)
        assert problem.sharpe(mixed) <= problem.sharpe(best) + 1e-9


def test_the_best_weights_beat_a_fine_lattice():
    values = np.array([RETURNS[s] for s in SYMBOLS])
    crypto = [s.endswith("USDT") for s in SYMBOLS]
    problem = _problem(values.mean(axis=1) * 365, np.cov(values) * 365, crypto)
    best = problem.sharpe(problem.solve([]))
    top = max(
        problem.sharpe(np.array([a, b, 50 - a - b - x - y, x, y]) / 50)
        for a in range(31)
        for b in range(31)
        for x in range(8)
        for y in range(8)
        if 0 <= 50 - a - b - x - y <= 30 and x + y <= 12
    )
    assert 0.9 * best < top <= best + 1e-12


@pytest.mark.parametrize("seed", range(6))
def test_without_excess_return_the_best_corner_wins(seed):
    """All returns are below the rate: every start must end at the best corner."""
    rng = np.random.default_rng(seed)
    problem = _random_problem(rng, 12, 0.9)
    found = problem.solve([problem.fill(rng.permutation(12)) for _ in range(2)])
    assert _feasible(problem, found)
    again = problem.solve([])
    assert problem.sharpe(again) == pytest.approx(problem.sharpe(found))
    # Corners are fillings in some order.
    order = list(range(12))
    rnd = random.Random(seed)
    for _ in range(4000):
        rnd.shuffle(order)
        assert problem.sharpe(problem.fill(order)) <= problem.sharpe(found) + 1e-9


def test_limits_of_exactly_a_third_are_feasible(spark):
    known = spark.createDataFrame(
        [([0.1, 0.2, 0.3], np.diag([0.1, 0.1, 0.1]).tolist())],
        "annual_returns array<double>, annual_covariances array<array<double>>",
    )
    asked = weights.problem(known, ["A", "B", "C"], {}, max_single=1 / 3)
    (row,) = allocate.optimize(asked, []).collect()
    assert row.weights == pytest.approx([1 / 3] * 3)
    with pytest.raises(ValueError, match="infeasible"):
        weights.problem(known, ["A", "B", "C"], {}, max_single=0.33)
    with pytest.raises(ValueError, match="infeasible"):
        weights.problem(known, ["AUSDT", "BUSDT", "CUSDT"], {})


def test_no_variance_has_no_best_weights():
    zero = np.zeros((3, 3))
    assert _problem([0.1, 0.2, 0.3], zero, [False] * 3).solve([]) is None


def test_starting_weights(spark):
    limits = weights.asset_limits(
        spark.createDataFrame([("A",), ("B",), ("CUSDT",)], "symbol string")
    )
    rows = [("own", "A", 0.6), ("own", "B", 0.6), ("equal", "A", 0.9), ("equal", "B", 0.1)]
    candidates = spark.createDataFrame(rows, "candidate_id string, symbol string, weight double")
    got = {(r[0], r[1]): r[2] for r in weights.starting_weights(candidates, limits).collect()}
    # A third of crypto exceeds its limit, so equal weights are no start here.
    assert got == {
        ("own", "A"): 0.5, ("own", "B"): 0.5, ("own", "CUSDT"): 0.0,
        ("equal", "A"): None, ("equal", "B"): None, ("equal", "CUSDT"): None,
    }
    plain = weights.asset_limits(spark.createDataFrame([("A",), ("B",)], "symbol string"))
    got = weights.starting_weights(candidates.filter("candidate_id = 'equal'"), plain).collect()
    assert {r.symbol: r.weight for r in got} == {"A": 0.5, "B": 0.5}


def test_clean_weights(spark):
    rows = [("a", "x", 1e-11), ("a", "y", 0.5), ("a", "z", 1.5), ("b", "x", 0.0)]
    df = spark.createDataFrame(rows, "candidate_id string, symbol string, weight double")
    got = {(r.candidate_id, r.symbol): r.weight for r in weights.clean_weights(df).collect()}
    assert got == {("a", "x"): 0.0, ("a", "y"): 0.25, ("a", "z"): 0.75, ("b", "x"): 0.0}


def test_optimize_reports_lookback_and_differences(spark):
    matrix = moments.complete_returns(fact_of(spark), SYMBOLS)
    summary, chosen = gold.optimize_returns(spark, matrix, SYMBOLS, HELD, risk_free_rate=0.04)
    (row,) = summary.collect()
    assert (row.as_of_date, row.observation_count) == (date(2026, 1, 25), 24)
    assert row.optimization_success and row.optimization_message.startswith("No move")
    rows = {r.symbol: r for r in chosen.collect()}
    assert set(rows) == set(SYMBOLS)
    for s, r in rows.items():
        assert r.current_weight == HELD[s]
        assert r.weight_difference == pytest.approx(r.optimized_weight - r.current_weight)


def test_optimize_needs_two_observations(spark):
    matrix = moments.complete_returns(fact_of(spark, {"A": [0.1], "B": [0.2]}), ["A", "B"])
    with pytest.raises(ValueError, match="two or more days"):
        gold.optimize_returns(spark, matrix, ["A", "B"], {"A": 0.5, "B": 0.5})


def test_a_symbol_that_is_not_held_counts_as_zero(spark):
    optimized = spark.createDataFrame([("N", 0.3)], "symbol string, weight double")
    held = spark.createDataFrame([("A", 0.5)], "symbol string, target_weight double")
    as_of = spark.createDataFrame([(date(2026, 1, 7),)], "lookback_end_date date")
    (row,) = weights.weight_difference(optimized, held, as_of, "p").collect()
    assert (row.current_weight, row.weight_difference) == (0.0, 0.3)
