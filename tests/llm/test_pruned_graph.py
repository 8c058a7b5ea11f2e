import numpy as np
import pytest

from marketloom.llm import pruned_graph as pg

SCHEMA = "vec_id long, embedding array<float>, label int, node long, shard string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 5, "x") for r in rows], SCHEMA)


def brute(rows):
    """n_links and component of each row, by comparing all pairs."""
    v = [None if e is None else np.array([np.nan if x is None else x for x in e], np.float32) for _, e, _ in rows]
    fit = [
        i for i, (vec_id, _, label) in enumerate(rows)
        if vec_id is not None and label is not None and v[i] is not None
        and len(v[i]) and np.isfinite(v[i]).all() and v[i].any()
    ]
    links = {i: set() for i in range(len(rows))}
    for i in fit:
        for j in fit:
            if i != j and rows[i][2] == rows[j][2] and len(v[i]) == len(v[j]):
                a, b = v[i].astype(float), v[j].astype(float)
                a, b = a / abs(a).max(), b / abs(b).max()
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.98:
                    links[i].add(j)
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        reached, new = {i}, [i]
        while new:
            new = [k for j in new for k in links[j] if k not in reached]
            reached.update(new)
        least = None if vec_id is None else min(rows[j][0] for j in reached)
        out.append((vec_id, len(links[i]), least, vec_id is None or vec_id == least))
    return sorted(out, key=str)


def found(spark, rows, **options):
    return sorted(map(tuple, pg.near_duplicates(frame(spark, rows), **options).collect()), key=str)


def clustered(rng, size, width=24):
    """Vectors with pairs of near copies, a chain of copies and one dense group."""
    base = rng.normal(size=(size, width))
    copies = base[: size // 4] + rng.normal(size=(size // 4, width)) * 0.08
    centre = rng.normal(size=width)
    dense = centre + rng.normal(size=(size // 3, width)) * 0.05
    chain = [rng.normal(size=width)]
    for _ in range(30):
        chain.append(chain[-1] + rng.normal(size=width) * 0.15)
    return np.concatenate([base, copies, dense, np.array(chain)]).astype(np.float32)


@pytest.mark.parametrize("shard_rows", [4_000, 90], ids=["whole", "split"])
def test_links_equal_brute_force(spark, shard_rows):
    rng = np.random.default_rng(1)
    v = clustered(rng, 300)
    rows = [(int(i * 7 % 1009), e.tolist(), int(rng.integers(2))) for i, e in enumerate(v)]
    rows += [(2000 + i, rows[i][1], rows[i][2]) for i in range(40)]
    assert found(spark, rows, shard_rows=shard_rows) == brute(rows)


def test_vectors_that_link_with_nothing(spark):
    one = [1.0, 2.0, 3.0]
    rows = [
        (1, one, 0), (2, one, 0), (3, one, 1), (4, one, None), (None, one, 0), (5, None, 0),
        (6, [0.0, 0.0, 0.0], 0), (7, [0.0, 0.0, 0.0], 0), (8, [1.0, None, 3.0], 0), (9, [], 0),
        (10, [float("nan"), 2.0, 3.0], 0), (11, [float("inf"), 2.0, 3.0], 0), (12, [1.0, 2.0], 0),
        (13, [1.0, 2.0], 0), (14, [1e-38, 2e-38, 3e-38], 0), (15, [1e38, 2e38, 3e38], 0),
        (1, one, 0), (1, [-1.0, -2.0, -3.0], 0), (16, [-0.0, 1.0, 0.0], 2), (17, [0.0, 1.0, -0.0], 2),
    ]
    got = found(spark, rows)
    assert got == brute(rows)
    assert (2, 4, 1, False) in got and (13, 1, 12, False) in got and (5, 0, 5, True) in got
    assert pg.near_duplicates(frame(spark, [])).collect() == []


def test_robust_pruning_drops_what_a_kept_one_stands_for():
    # Distances 1, 1.1 and 2 from the row; the second lies beside the first.
    own = np.array([[1.0, 1.1, 2.0]])
    others = np.array([[[0, 0.2, 2.5], [0.2, 0, 2.4], [2.5, 2.4, 0]]])
    assert pg.robust_pruned(own, others, 16, 1.2).tolist() == [[True, False, True]]
    assert pg.robust_pruned(own, others, 1, 1.2).tolist() == [[True, False, False]]


def test_search_finds_near_nodes_and_visits_few():
    rng = np.random.default_rng(2)
    base = rng.normal(size=(1500, 48))
    v = np.concatenate([base, base[:300] + rng.normal(size=(300, 48)) * 0.1])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    lists = pg.build(v, pg.CANDIDATES, rng)
    assert max(map(len, lists)) <= 4 * pg.DEGREE + pg.RANDOM_LINKS
    links = np.full((len(v), max(map(len, lists))), -1)
    for i, near in enumerate(lists):
        links[i, : len(near)] = near
    medoids = rng.choice(len(v), pg.MEDOIDS, replace=False)
    i, j = pg.search(v, v, links, medoids, pg.BEAM)
    got = {(a, b) for a, b in zip(i.tolist(), j.tolist()) if a != b}
    wanted = {(k, 1500 + k) for k in range(300) if v[k] @ v[1500 + k] >= 0.98}
    assert len(wanted) > 200 and len(wanted - got) <= 0.02 * len(wanted)


def test_a_link_counts_in_the_least_shared_shard():
    none = pg.NO_SHARD
    ours, theirs = np.array([[1, 5], [5, none]]), np.array([[5, 9], [1, 5]])
    assert pg.first_shared(ours, theirs, 5).tolist() == [True, True]
    assert pg.first_shared(ours, np.array([[1, 5], [5, 9]]), 5).tolist() == [False, True]


def test_pivots_of_linked_vectors_overlap():
    """The second pivot is left out only where no link can lead across."""
    rng = np.random.default_rng(3)
    pivots = rng.normal(size=(6, 16))
    pivots /= np.linalg.norm(pivots, axis=1, keepdims=True)
    a = rng.normal(size=(4000, 16))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = a + rng.normal(size=a.shape) * 0.04
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    reach = (2 - 2 * 0.98) ** 0.5
    one, two = (pg.nearest_pivots(x, pivots, 6, reach) for x in (a, b))
    linked = (a * b).sum(axis=1) >= 0.98
    assert linked.sum() > 1000 and any(len(x) < 6 for x in one)
    for i in np.flatnonzero(linked):
        assert one[i][0] in two[i] and two[i][0] in one[i]


def test_audit_sees_what_is_missing(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 12))
    rows = [(i, 0, 12, (base[i % 60] * (1 + i)).tolist(), 1) for i in range(120)]
    schema = "node long, label int, width int, v array<double>, copies long"
    nodes = spark.createDataFrame(rows, schema)
    every = spark.createDataFrame([(i, 1, None) for i in range(120)], pg.FOUND)
    assert pg.recall(nodes, every) == 1.0
    assert pg.recall(nodes, every.filter("node < 60")) == 0.5
    assert pg.recall(nodes.filter("node < 60"), every.filter("false")) == 1.0
