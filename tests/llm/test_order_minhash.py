import random
from collections import Counter

import numpy as np
import pytest

from marketloom.llm import order_minhash
from marketloom.llm.graph import components


def _text(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def _classes(documents, rows, **options):
    found = order_minhash.near_duplicates(documents(rows), **options).collect()
    return {r.doc_id: r.class_id for r in found}, found


def _longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            row[j + 1], before = (before + 1 if x == y else max(row[j], row[j + 1])), row[j + 1]
    return row[-1]


def test_alignment_equals_longest_common_subsequence():
    rng = random.Random(5)
    for _ in range(600):
        a = [rng.randrange(rng.choice([2, 40])) for _ in range(rng.randrange(40))]
        b = list(a)
        for _ in range(rng.randrange(8)):
            place = rng.randrange(len(b) + 1)
            b[place : place + rng.randrange(2)] = [rng.randrange(40)] * rng.randrange(2)
        best = _longest(a, b)
        x, y = np.array(a, np.uint64), np.array(b, np.uint64)
        assert order_minhash.aligned(x, y, len(a) + len(b) - 2 * best) == best
        assert order_minhash.aligned(x, y, 1) <= best


def test_frequent_elements_align(monkeypatch):
    monkeypatch.setattr(order_minhash, "FREQUENT", 2)
    rng = random.Random(6)
    for _ in range(200):
        a = [rng.randrange(3) for _ in range(rng.randrange(30))]
        b = [rng.randrange(3) for _ in range(rng.randrange(30))]
        best = _longest(a, b)
        x, y = np.array(a, np.uint64), np.array(b, np.uint64)
        assert order_minhash.aligned(x, y, 60) == best


def _similar(a, b):
    common = _longest(a, b)
    return bool(a and b) and common / (len(a) + len(b) - common) >= 0.8


def test_recall_of_edits(documents):
    """At least 0.9 of the copies at every share of replaced words that the threshold admits."""
    rng = random.Random(11)
    rows, pairs = [], {}
    for share in (0.01, 0.03, 0.05, 0.07, 0.09, 0.11):
        for length in (60, 200, 800):
            for _ in range(40):
                text = _text(rng, length)
                copy = list(text)
                for place in rng.sample(range(length), max(1, int(length * share))):
                    copy[place] = f"new{rng.randrange(10**6)}"
                one = len(rows)
                rows += [(one, " ".join(text)), (one + 1, " ".join(copy))]
                pairs.setdefault(share, []).append(one)
    got, _ = _classes(documents, rows)
    for share, ones in pairs.items():
        found = sum(got[one + 1] == one for one in ones) / len(ones)
        assert found >= 0.9, (share, found)
    assert all(class_id // 2 == doc_id // 2 for doc_id, class_id in got.items())


def test_classes_equal_brute_force(documents):
    rng = random.Random(7)
    texts = []
    for _ in range(12):
        base = _text(rng, rng.randrange(30, 120))
        texts.append(base)
        for _ in range(5):
            copy = list(rng.choice(texts[-3:]))
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = f"w{rng.randrange(5000)}"
            texts.append(copy)
    order = list(range(len(texts)))
    rng.shuffle(order)
    texts = [texts[i] for i in order]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if _similar(texts[i], texts[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    got, _ = _classes(documents, [(i, " ".join(t)) for i, t in enumerate(texts)])
    assert got == {i: root(i) for i in range(len(texts))}
    assert 1 < len(set(got.values())) < len(texts)


def test_chain_of_edits_is_one_class(documents):
    rng = random.Random(8)
    text = _text(rng, 200)
    rows = []
    for i in range(30):
        rows.append((100 - i, " ".join(text)))
        text[7 * i % 200] = f"new{i}"
        text[(7 * i + 90) % 200] = f"other{i}"
    got, _ = _classes(documents, rows)
    assert set(got.values()) == {71}


def test_moved_halves_are_no_copies(documents):
    rng = random.Random(9)
    text = _text(rng, 100)
    got, _ = _classes(documents, [(1, " ".join(text)), (2, " ".join(text[50:] + text[:50]))])
    assert got == {1: 1, 2: 2}


def test_odd_rows(documents):
    rows = [
        (1, None),
        (2, None),
        (3, ""),
        (4, ""),
        (5, "!!"),
        (6, "one two"),
        (7, "One, two!"),
        (8, "one three"),
        (None, "one two"),
        (9, "a " * 30_000),
        (10, "a " * 30_001),
        (6, "one two"),
    ]
    got, found = _classes(documents, rows)
    assert len(found) == len(rows)
    assert got == {1: 1, 2: 2, 3: 3, 4: 3, 5: 5, 6: 6, 7: 6, 8: 8, None: None, 9: 9, 10: 9}
    assert order_minhash.near_duplicates(documents([])).collect() == []


def test_one_of_each(documents):
    rows = [(3, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (5, "x"), (None, "x")]
    frame = documents(rows)
    kept = order_minhash.one_of_each(frame)
    assert kept.columns == frame.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([2, 5, None])


def test_texts_of_a_repeated_id(documents):
    rng = random.Random(12)
    a, b, c = (" ".join(_text(rng, 80)) for _ in range(3))
    near = a.replace(a.split()[40], "other", 1)
    rows = [(7, a), (7, b), (3, near), (9, c), (9, c), (9, c.upper()), (7, None), (4, b)]
    found = order_minhash.near_duplicates(documents(rows)).collect()
    assert sorted((r.doc_id, r.class_id) for r in found) == sorted(
        [(7, 3), (7, 4), (3, 3), (9, 9), (9, 9), (9, 9), (7, 7), (4, 4)]
    )
    kept = order_minhash.one_of_each(documents(rows)).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter(
        [(3, near), (4, b), (9, c.upper()), (7, None)]
    )
    clean = [(7, a), (7, b), (7, c)]
    kept = order_minhash.one_of_each(documents(clean)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted(clean)


def test_components(spark):
    rng = random.Random(10)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    pairs += [(100 + i, 101 + i) for i in range(50)]
    parent = {x: x for p in pairs for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    got = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {x: root(x) for x in linked}
    assert len(got) == len(linked)


@pytest.mark.parametrize("crossed", [False, True])
def test_a_group_of_copies_gives_as_many_links_as_members(crossed):
    """Every two of them were a row of the join that verified them."""
    import pyarrow as pa

    rng = np.random.default_rng(5)
    first, members = rng.integers(1, 1 << 62, 100), 40
    texts = []
    for k in range(members):
        texts.append(first.copy())
        texts[-1][k] = k
    texts.append(rng.integers(1, 1 << 62, 100))
    marks = [order_minhash.sketch(t)[1].tobytes() for t in texts]
    n = len(texts)
    bucket = 7
    block = {
        "block": 1, "nodes": list(range(n)), "components": list(range(n)), "sizes": [100] * n,
        "signatures": b"".join(marks), "sketches": [bucket] * n,
        "words": b"".join(t.tobytes() for t in texts),
    }
    row = {"bucket": bucket, **block}
    if crossed:
        shift = [x + n for x in block["nodes"]]
        row |= {f"{k}_": v for k, v in (block | {"nodes": shift, "components": shift}).items()}
    kinds = {"bucket": pa.int64(), **order_minhash.BLOCK}
    schema = pa.schema([(k, kinds[k.removesuffix("_")]) for k in row])
    batch = pa.RecordBatch.from_pylist([row], schema)
    (found,) = order_minhash._compared(iter([batch]), 0.8)
    pairs = list(zip(*(found[c].to_pylist() for c in ("a", "b")), strict=True))
    groups = {k: k for k in range(2 * n)}
    for a, b in pairs:
        low, high = sorted((groups[a], groups[b]))
        assert low != high
        groups = {k: low if g == high else g for k, g in groups.items()}
    ids = [*range(members), *range(n, n + members)] if crossed else range(members)
    assert len({groups[k] for k in ids}) == 1
    other = 1 if crossed else 0
    assert len(pairs) == len(ids) - 1 + other


def test_blocks_hold_words_and_no_signatures(spark, documents, monkeypatch):
    tables = {}

    def written(df, purpose):
        tables.setdefault(purpose, []).append(df)
        return common_written(df, purpose)

    common_written = order_minhash.written
    monkeypatch.setattr(order_minhash, "written", written)
    base = " ".join(f"w{i}" for i in range(200))
    rows = [(i, f"{base} {' '.join(f'x{i}y{j}' for j in range(30 * (i % 3)))}") for i in range(12)]
    order_minhash.near_duplicates(documents(rows)).collect()
    for purpose in ("near-sketches", "near-representatives", "near-blocks"):
        assert not [c for c in tables[purpose][0].columns if c.startswith("signature")]
    assert order_minhash.BLOCK_ROWS >= 1024


def test_words_meet_members_once_and_only_split_buckets_are_crossed(spark, documents, monkeypatch):
    """Rows with words were ranged, which ran their join twice; every block was joined with others."""
    plans, tables = {}, {}

    def written(df, purpose):
        plans.setdefault(purpose, []).append(df._jdf.queryExecution().toString())
        tables[purpose] = common_written(df, purpose)
        return tables[purpose]

    common_written = order_minhash.written
    monkeypatch.setattr(order_minhash, "written", written)
    rng = random.Random(13)
    passage, texts = _text(rng, 40), []
    for i in range(1100):
        texts.append(passage + [f"own{i}x{j}" for j in range(20)])
    for i in range(0, 1100, 100):
        texts.append([*texts[i][:50], f"other{i}", *texts[i][51:]])
    got, _ = _classes(documents, [(i, " ".join(t)) for i, t in enumerate(texts)])
    assert got == {i: i if i < 1100 else (i - 1100) * 100 for i in range(len(texts))}
    assert "rangepartitioning" not in plans["near-blocks"][0].lower()
    assert "isnotnull(split" in plans["near-links"][-1].lower()
    blocks = tables["near-blocks"]
    assert {r.split for r in blocks.select("split").distinct().collect()} == {True, False}
    assert blocks.filter("split").groupBy("bucket").count().filter("count < 2").isEmpty()
    assert blocks.filter("NOT split").groupBy("bucket").count().filter("count > 1").isEmpty()
    per_node = tables["near-numbered"].groupBy("node").count()
    assert per_node.filter(f"count > {order_minhash.HASHES}").isEmpty()
    raw = sum(8 * n for r in blocks.select("sizes").collect() for n in r.sizes)
    assert sum(len(r.words) for r in blocks.select("words").collect()) < raw / 2
