import math
import random

import pytest

from marketloom.llm import pivot_topk


def _brute(rows, queries, k, scale=256):
    def whole(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(x * scale) for x in v]

    out = []
    have = [(i, w) for i, v in rows if i is not None and (w := whole(v)) is not None]
    for query_id, v in queries:
        q = whole(v)
        if query_id is None or q is None:
            continue
        found = sorted(
            (-sum(a * b for a, b in zip(q, w)), i) for i, w in have if i != query_id
        )
        out += [(query_id, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return sorted(out)


def _search(spark, rows, queries, **options):
    schema = "vec_id long, embedding array<float>, label int, distance string"
    frame = [spark.createDataFrame([(*r, 1, "x") for r in t], schema) for t in (rows, queries)]
    return sorted(map(tuple, pivot_topk.search(*frame, **options).collect()))


def _vector(rng, width=6):
    return [rng.randrange(-512, 512) / 256 for _ in range(width)]


@pytest.mark.parametrize("annulus", [4, 512])
def test_equals_brute_force(spark, monkeypatch, annulus):
    monkeypatch.setattr(pivot_topk, "ANNULUS_ROWS", annulus)
    monkeypatch.setattr(pivot_topk, "BLOCK_QUERIES", 3)
    rng = random.Random(annulus)
    rows = [(i, _vector(rng)) for i in range(150)]
    rows += [(1000 + i, rows[5][1]) for i in range(40)]
    queries = rows[::10]
    assert _search(spark, rows, queries) == _brute(rows, queries, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0]),
        (2, None),
        (3, [nan, 1.0]),
        (4, [inf, 1.0]),
        (5, [None, 1.0]),
        (6, [1.0]),
        (7, []),
        (None, [1.0, 1.0]),
        (8, [0.5, 0.5]),
        (8, [0.5, 0.5]),
        (9, [-1.0, -0.001]),
    ]
    assert _search(spark, rows, rows) == _brute(rows, list(dict(rows).items()), 5)
    assert _search(spark, [], rows) == []
    assert _search(spark, rows, []) == []
    with pytest.raises(ValueError, match="exact"):
        _search(spark, [(1, [1e20]), (2, [1.0])], [(2, [1.0])])
