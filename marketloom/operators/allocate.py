"""Weights with the greatest Sharpe ratio under limits, for many symbol lists at once.

The search is a table of states, a row for each problem and start: the weights with the slopes
they lead to. A round moves every open row up to ``MOVES`` times, by expressions over its arrays, and
writes the rows; those that no move improves are done. Starts of one problem are
rows of their own, spread over the tasks, and the best of them goes on.

Weight moves between two symbols. Limits on single symbols, on all crypto symbols and on
the total form a family of nested sets, for which every feasible direction is a sum of such moves:
weights that no move between two symbols improves are optimal to first order. Where some
feasible weights return more than the risk-free rate the ratio has no other local optima,
and the moves lead to the optimum from any weights with such a return. Where none do, the
ratio is greatest in a corner of the limits; corners are searched from a start for each
symbol besides the given and the equal weights.

``certificates`` judges weights by the moments alone, whatever search they come from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom import config
from marketloom.sources.tables import stored

GRADIENT_TOLERANCE = 1e-6
# Moves of a row in one round, and the least weight that moves.
MOVES, LEAST_MOVE = 200, 1e-15
NEEDED = ["annual_returns", "annual_covariances", "upper_bounds", "is_crypto", "start_weights"]


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _dot(x: str, y: str) -> str:
    return f"aggregate(zip_with({x}, {y}, (p, q) -> p * q), 0D, (t, p) -> t + p)"


def _sharpe(excess: str, variance: str) -> str:
    """Null where the ratio is undefined."""
    return f"CASE WHEN {variance} > 0D THEN {excess} / sqrt({variance}) END"


def _moved(state: str, move: str) -> tuple[str, str]:
    """Weights and risk after ``move`` (i, j, t): t goes from symbol i to symbol j."""
    weights = (
        f"transform({state}.w, (x, k) -> CASE k WHEN {move}.i THEN x - {move}.t "
        f"WHEN {move}.j THEN x + {move}.t ELSE x END)"
    )
    risk = (
        f"zip_with({state}.risk, zip_with(annual_covariances[{move}.j], "
        f"annual_covariances[{move}.i], (p, q) -> p - q), (r, d) -> r + {move}.t * d)"
    )
    return weights, risk


def _state(weights: str, risk: str, rate: float, rest: str) -> str:
    """Weights with their risk, variance and excess return, and the progress of the search."""
    made = f"named_struct('w', {weights}, 'risk', {risk})"
    return _let(
        "z",
        made,
        f"named_struct('w', z.w, 'risk', z.risk, 'c', {_dot('z.w', 'z.risk')}, "
        f"'a', {_dot('z.w', 'annual_returns')} - {rate!r}D, {rest})",
    )


def _steepest(crypto_total: float) -> str:
    """The move of the greatest gain in slope that state s allows: gain, i, j, room.

    The symbol of the least slope that can fall and that of the greatest that can rise are
    found in each class; four pairs of them are compared.
    """
    slopes = "zip_with(annual_returns, s.risk, (m, r) -> (m * s.c - s.a * r) / pow(s.c, 1.5D))"
    items = (
        "transform(g, (y, k) -> named_struct('g', y, 'k', k, 'w', s.w[k], "
        "'up', upper_bounds[k] - s.w[k], 'crypto', is_crypto[k]))"
    )
    room_left = (
        f"greatest(0D, {crypto_total!r}D - aggregate(zip_with(s.w, is_crypto, "
        "(w, c) -> if(c, w, 0D)), 0D, (t, x) -> t + x))"
    )

    def falls(crypto: str) -> str:
        return f"array_min(filter(xs, x -> x.w > {LEAST_MOVE!r}D AND x.crypto = {crypto}))"

    def rises(crypto: str) -> str:
        return f"array_max(filter(xs, x -> x.up > {LEAST_MOVE!r}D AND x.crypto = {crypto}))"

    def pair(fall: str, rise: str, room: str = "f.up") -> str:
        most = "least(f.w, r.up)" if room == "f.up" else f"least(f.w, r.up, {room})"
        made = f"named_struct('gain', r.g - f.g, 'i', f.k, 'j', r.k, 'room', {most})"
        return _let("f", falls(fall), _let("r", rises(rise), made))

    pairs = [pair("false", "false"), pair("true", "false"), pair("true", "true")]
    enters = pair("false", "true", "cl")
    best = (
        f"array_max(filter(array({', '.join(pairs)}, "
        f"if(cl > {LEAST_MOVE!r}D, {enters}, NULL)), x -> x.gain IS NOT NULL))"
    )
    return _let("g", slopes, _let("xs", items, _let("cl", room_left, best)))


def _ascended(rate: float, crypto_total: float) -> str:
    """State s after a move along the steepest pair, to the best point on its way.

    Near the optimum a move gains less than a double shows. Such moves go on while the steepest
    slope falls; when it has not fallen for as many moves as there are pairs, it is noise.
    """
    # The slope of (a + b t) / sqrt(c + 2 d t + e t^2) has the sign of b c - a d + (b d - a e) t.
    parts = (
        "named_struct('d', s.risk[v.j] - s.risk[v.i], 'b', annual_returns[v.j] - annual_returns[v.i], "
        "'e', annual_covariances[v.i][v.i] + annual_covariances[v.j][v.j] "
        "- 2D * annual_covariances[v.i][v.j])"
    )
    step = (
        "if(p.b * p.d - s.a * p.e < 0D, least(v.room, "
        "-(p.b * s.c - s.a * p.d) / (p.b * p.d - s.a * p.e)), v.room)"
    )
    move = _let("p", parts, f"named_struct('i', v.i, 'j', v.j, 't', {step})")
    better = f"(v.gain < s.least OR {_sharpe('s.a', 's.c')} > s.best_ratio)"
    progress = (
        f"'least', least(s.least, v.gain), 'since', if({better}, 0, s.since + 1), "
        f"'best', if({better}, s.w, s.best), "
        f"'best_ratio', if({better}, {_sharpe('s.a', 's.c')}, s.best_ratio)"
    )
    after = _state(*_moved("s", "u"), rate, f"{progress}, 'done', false")
    stays = (
        "named_struct('w', s.w, 'risk', s.risk, 'c', s.c, 'a', s.a, "
        f"{progress}, 'done', true)"
    )
    ends = f"(v.gain < {GRADIENT_TOLERANCE / 100!r}D OR s.since > size(s.w) * size(s.w))"
    moved = _let("u", move, after)
    done = (
        "named_struct('w', s.w, 'risk', s.risk, 'c', s.c, 'a', s.a, 'least', s.least, "
        "'since', s.since, 'best', s.best, 'best_ratio', s.best_ratio, 'done', true)"
    )
    # Nothing can move: these weights are the only ones.
    alone = (
        "named_struct('w', s.w, 'risk', s.risk, 'c', s.c, 'a', s.a, 'least', s.least, "
        f"'since', s.since, 'best', s.w, 'best_ratio', {_sharpe('s.a', 's.c')}, 'done', true)"
    )
    chosen = f"CASE WHEN v IS NULL THEN {alone} WHEN {ends} THEN {stays} ELSE {moved} END"
    return f"if(s.done OR NOT s.c > 0D, {done}, {_let('v', _steepest(crypto_total), chosen)})"


def _cornered(rate: float, crypto_total: float) -> str:
    """State s after the best of all whole moves between two symbols, if it is better."""
    cl = (
        f"greatest(0D, {crypto_total!r}D - aggregate(zip_with(s.w, is_crypto, "
        "(w, c) -> if(c, w, 0D)), 0D, (t, x) -> t + x))"
    )
    # What a move takes of symbol i alone is looked up once for all j.
    falling = (
        "named_struct('w', s.w[i], 'risk', s.risk[i], 'mean', annual_returns[i], "
        "'crypto', is_crypto[i], 'row', annual_covariances[i], 'own', annual_covariances[i][i])"
    )
    room = "least(f.w, upper_bounds[j] - s.w[j], if(is_crypto[j] AND NOT f.crypto, cl, f.w))"
    variance = (
        "s.c + 2D * m * (s.risk[j] - f.risk) + m * m * (f.own "
        "+ annual_covariances[j][j] - 2D * f.row[j])"
    )
    excess = "(s.a + m * (annual_returns[j] - f.mean))"
    ratio = _let("v", f"if(m > {LEAST_MOVE!r}D AND i <> j, {variance}, NULL)", _sharpe(excess, "v"))
    value = f"named_struct('ratio', {ratio}, 'ni', -i, 'nj', -j, 't', m)"
    places = "filter(sequence(0, size(s.w) - 1), k -> {} > " + f"{LEAST_MOVE!r}D)"
    falls, rises = places.format("s.w[k]"), places.format("upper_bounds[k] - s.w[k]")
    of_symbol = _let("f", falling, f"transform(rising, j -> {_let('m', room, value)})")
    pairs = _let("rising", rises, f"flatten(transform({falls}, i -> {of_symbol}))")
    best = _let("cl", cl, f"array_max(filter({pairs}, x -> x.ratio IS NOT NULL))")
    move = "named_struct('i', -v.ni, 'j', -v.nj, 't', v.t)"
    rest = (
        "'least', s.least, 'since', s.since, 'best', s.best, 'best_ratio', s.best_ratio"
    )
    after = _let("u", move, _state(*_moved("s", "u"), rate, f"{rest}, 'done', false"))
    done = f"named_struct('w', s.w, 'risk', s.risk, 'c', s.c, 'a', s.a, {rest}, 'done', true)"
    ratio = _sharpe("s.a", "s.c")
    improves = f"v.ratio > coalesce({ratio}, double('-infinity')) + 1e-15D"
    chosen = f"CASE WHEN {improves} THEN {after} ELSE {done} END"
    return f"if(s.done, {done}, {_let('v', best, chosen)})"


def _begun(rate: float) -> str:
    """The state of ``_start``; its risk is computed anew, which ends rounding errors of moves."""
    rest = (
        "'least', double('infinity'), 'since', 0, 'best', _start, "
        "'best_ratio', CAST(NULL AS DOUBLE), 'done', false"
    )
    return _state("_start", f"transform(annual_covariances, r -> {_dot('r', '_start')})", rate, rest)


def _filled(order: str, crypto_total: float) -> str:
    """All weight, given to the symbols in turn as far as the limits allow."""
    room = "least(upper_bounds[k], t.rest, if(is_crypto[k], t.crypto, t.rest))"
    step = _let(
        "m",
        room,
        "named_struct('rest', t.rest - m, 'crypto', if(is_crypto[k], t.crypto - m, t.crypto), "
        "'placed', array_append(t.placed, named_struct('k', k, 'w', m)))",
    )
    empty = "CAST(array() AS array<struct<k: int, w: double>>)"
    start = f"named_struct('rest', 1D, 'crypto', {crypto_total!r}D, 'placed', {empty})"
    placed = f"aggregate({order}, {start}, (t, k) -> {step}).placed"
    return f"transform(array_sort({placed}), x -> x.w)"


def _searched(starts: DataFrame, problems: DataFrame, start: str, step: str, rate: float) -> DataFrame:
    """(_problem, _number, _state) of the starts after rounds of moves, until every one is done.

    ``start`` is the weights that a row begins with, of columns of ``starts`` and ``problems``.
    What is written and dealt are states alone: the moments, which grow with the square of a
    list, are joined to them in each round.
    """
    tasks = starts.sparkSession.sparkContext.defaultParallelism
    begun = F.expr(_let("_start", start, _begun(rate)))
    moves = F.expr(f"aggregate(sequence(1, {MOVES}), _state, (s, n) -> {step})")
    done, open_rows = None, starts
    while True:
        dealt = open_rows.repartition(tasks, "_problem", "_number").join(problems, "_problem")
        if done is None:
            dealt = dealt.withColumn("_state", begun)
        moved = dealt.select("_problem", "_number", moves.alias("_state"))
        going = F.when(~F.col("_state.done"), F.col("_state.risk"))
        moved = stored(
            moved.withColumn("_state", F.col("_state").withField("risk", going)), "weight-search"
        )
        ended = moved.filter("_state.done")
        done = ended if done is None else done.unionByName(ended)
        open_rows = moved.filter("NOT _state.done")
        if open_rows.isEmpty():
            return done


def optimize(
    problems: DataFrame,
    by: list[str],
    risk_free_rate: float = config.RISK_FREE_RATE,
    max_crypto_total: float = config.MAX_CRYPTO_TOTAL_WEIGHT,
) -> DataFrame:
    """Best weights of each row: the columns ``by`` and ``weights`` in symbol order.

    Rows hold annual_returns, annual_covariances, upper_bounds, is_crypto and
    start_weights (or NULL). ``weights`` is NULL where the limits leave no room for full
    weight or no weights have a positive variance.
    """
    rate, crypto_total = float(risk_free_rate), float(max_crypto_total)
    others = [c for c in NEEDED if c not in by]
    asked = stored(
        problems.select(*by, *others).withColumn("_problem", F.monotonically_increasing_id()),
        "weight-problems",
    )
    by_return = (
        "transform(array_sort(transform(annual_returns, (m, k) -> "
        "named_struct('m', -m, 'k', k))), x -> x.k)"
    )
    known = asked.select("_problem", *NEEDED).filter(
        "annual_returns IS NOT NULL AND size(annual_returns) > 0"
    )
    ordered = known.withColumn("_order", F.expr(by_return))
    rich = ordered.withColumn("_richest", F.expr(_filled("_order", crypto_total)))
    full = f"abs(aggregate(_richest, 0D, (t, x) -> t + x) - 1D) <= {config.WEIGHT_TOLERANCE!r}D"
    rich = rich.filter(full).withColumn(
        "_rich", F.expr(f"{_dot('_richest', 'annual_returns')} > {rate!r}D")
    )
    rich = stored(rich, "weight-starts")
    # Where nothing returns more than the rate, the best corner over many starts comes first.
    given = "if(start_weights IS NULL, array(_richest), array(start_weights, _richest))"
    first = _let(
        "i",
        f"_order[_number - size({given})]",
        _filled("concat(array(i), array_remove(_order, i))", crypto_total),
    )
    corner = f"if(_number < size({given}), get({given}, _number), {first})"
    numbers = f"sequence(0, size({given}) + size(_order) - 1)"
    poor = rich.filter("NOT _rich").select("_problem", F.explode(F.expr(numbers)).alias("_number"))
    starts = rich.filter("_rich").select(
        "_problem", F.lit(0).alias("_number"), F.col("_richest").alias("_begin")
    )
    if not poor.isEmpty():
        corners = _searched(poor, rich, corner, _cornered(rate, crypto_total), rate).select(
            "_problem",
            F.struct(
                F.expr(f"coalesce({_sharpe('_state.a', '_state.c')}, double('-infinity'))").alias("r"),
                (-F.col("_number")).alias("n"),
                F.col("_state.w").alias("w"),
            ).alias("_corner"),
        )
        best = corners.groupBy("_problem").agg(F.max("_corner").alias("_best"))
        starts = starts.unionByName(
            best.select("_problem", F.lit(0).alias("_number"), F.col("_best.w").alias("_begin"))
        )
    found = _searched(starts, rich, "_begin", _ascended(rate, crypto_total), rate)
    solved = found.filter("_state.best_ratio IS NOT NULL").select(
        "_problem", F.col("_state.best").alias("weights")
    )
    return asked.join(solved, "_problem", "left").select(*by, "weights")


def certificates(
    solved: DataFrame,
    risk_free_rate: float = config.RISK_FREE_RATE,
    max_crypto_total: float = config.MAX_CRYPTO_TOTAL_WEIGHT,
    tolerance: float = config.WEIGHT_TOLERANCE,
) -> DataFrame:
    """Add ``within_limits`` and ``best_gain`` to rows of problems with their ``weights``.

    ``best_gain`` is the greatest difference in slope of the Sharpe ratio over all moves that the
    limits allow, from a symbol that can fall to one that can rise: the four kinds of
    moves are compared by the extremes of each class.
    """
    dot = "aggregate(zip_with({}, {}, (x, y) -> x * y), 0D, (t, x) -> t + x)"
    slopes = solved.selectExpr(
        "*", f"transform(annual_covariances, r -> {dot.format('r', 'weights')}) AS _risk"
    ).selectExpr(
        "*",
        f"{dot.format('weights', '_risk')} AS _variance",
        f"{dot.format('weights', 'annual_returns')} - {float(risk_free_rate)!r}D AS _excess",
        "aggregate(zip_with(weights, is_crypto, (w, c) -> if(c, w, 0D)), 0D, (t, x) -> t + x) "
        "AS _crypto",
        "aggregate(weights, 0D, (t, x) -> t + x) AS _total",
    ).selectExpr(
        "*",
        "zip_with(zip_with(annual_returns, _risk, (m, s) -> "
        "try_divide(m * _variance - _excess * s, pow(_variance, 1.5))), arrays_zip(weights, "
        "upper_bounds, is_crypto), (g, x) -> named_struct('g', g, 'w', x.weights, "
        "'cap', x.upper_bounds, 'crypto', x.is_crypto)) AS _symbols",
    )

    def least(crypto: str) -> str:
        falls = f"filter(_symbols, x -> x.w > {tolerance!r}D AND x.crypto = {crypto})"
        return f"array_min(transform({falls}, x -> x.g))"

    def most(crypto: str) -> str:
        rises = f"filter(_symbols, x -> x.w < x.cap - {tolerance!r}D AND x.crypto = {crypto})"
        return f"array_max(transform({rises}, x -> x.g))"

    has_room = f"_crypto < {max_crypto_total - tolerance!r}D"
    gains = [
        f"{most('false')} - {least('false')}",
        f"{most('false')} - {least('true')}",
        f"{most('true')} - {least('true')}",
        f"if({has_room}, {most('true')} - {least('false')}, NULL)",
    ]
    within = (
        f"abs(_total - 1) <= {tolerance!r}D AND _crypto <= {max_crypto_total + tolerance!r}D "
        f"AND forall(_symbols, x -> x.w BETWEEN -{tolerance!r}D AND x.cap + {tolerance!r}D)"
    )
    return slopes.selectExpr(
        "* EXCEPT (_risk, _variance, _excess, _crypto, _total, _symbols)",
        f"{within} AS within_limits",
        f"coalesce(array_max(array({', '.join(gains)})), 0D) AS best_gain",
    )
