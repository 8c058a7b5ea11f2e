import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from marketloom.llm import source_schedule


def _targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Reshare the excess of capped sources until none is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] if None in sizes else []
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(capped.values())
        target = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s: most * sizes[s] for s in free if target[s] > most * sizes[s]}
        if not over:
            return {**capped, **target}
        capped |= over


def _rows(rng, n):
    rows = []
    for i in range(n):
        source = rng.choice(["b", "a", "Z", "é", None, "b", "b"])
        text = rng.choice([None, "", "\t x \n"]) if i % 17 == 0 else "w " * rng.randrange(1, 300)
        rows.append((i, text, None, source))
    return rows


def test_targets_and_taken(spark, documents):
    rng = random.Random(1)
    rows = _rows(rng, 400)
    segments, sizes = source_schedule.mix(documents(rows), block=64)
    got = source_schedule.taken_words(segments, sizes).collect()
    assert len(got) == len(rows)
    size = {i: len((t or "").split()) for i, t, *_ in rows}
    total = defaultdict(int)
    for i, _, _, source in rows:
        total[source] += size[i]
    target = _targets(total)
    taken = defaultdict(int)
    for r in got:
        source = rows[r.doc_id][3]
        assert (r.size, r.source_size) == (size[r.doc_id], total[source])
        assert abs(r.target - target[source]) < 1e-6 * (1 + target[source])
        assert 0 <= r.taken <= 2 * r.size
        taken[source] += r.taken
    for source, words in taken.items():
        assert target[source] - 1 < words <= target[source]
    again = source_schedule.taken_words(*source_schedule.mix(documents(rows[::-1]), block=64))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got))


def test_segments_fill_the_slots(spark, documents):
    rng = random.Random(2)
    rows = _rows(rng, 300)
    source = {r[0]: r[3] for r in rows}
    segments, _ = source_schedule.mix(documents(rows), block=50)
    by_slot = defaultdict(list)
    for r in segments.collect():
        by_slot[r.slot].append(r)
    words, slots = defaultdict(int), []
    for slot in sorted(by_slot):
        own = sorted(by_slot[slot], key=lambda r: r.slot_offset)
        (name,) = {source[r.doc_id] for r in own}
        at = 0
        for r in own:
            assert r.slot_offset == at and r.n_words > 0
            at += r.n_words
        assert at <= 50
        words[name] += at
        slots.append(name)
    # Any stretch of the schedule is close to the whole in its shares.
    half = slots[: len(slots) // 2]
    for name in words:
        assert abs(half.count(name) / len(half) - slots.count(name) / len(slots)) < 0.05


def test_every_source_gets_its_slots(spark):
    rows = [("big", 0, 10_000_000, 1e7), ("small", 1, 1, 1.0), ("mid", 2, 500, 999.5)]
    frame = spark.createDataFrame(
        [(s, p, z, t) for s, p, z, t in rows], "source string, position int, source_size long, target double"
    )
    sums = source_schedule.schedule(frame, 100).groupBy("source").agg(
        F.sum("words").alias("w"), F.count("*").alias("n"), F.max("rank").alias("r")
    )
    got = {r.source: (r.w, r.n, r.r) for r in sums.collect()}
    assert got == {"big": (10**7, 10**5, 10**5 - 1), "small": (1, 1, 0), "mid": (999, 10, 9)}


def test_odd_rows(documents):
    rows = [(1, "a b c", None, "s"), (1, "a b c", None, "s"), (1, "d e", None, "s"), (None, "x", None, "s")]
    segments, sizes = source_schedule.mix(documents(rows))
    got = source_schedule.taken_words(segments, sizes).collect()
    assert sorted(r["size"] for r in got) == [1, 2, 3, 3]
    assert sum(r.taken for r in got) == 13
    empty = source_schedule.taken_words(*source_schedule.mix(documents([])))
    assert empty.collect() == []
    blank = source_schedule.taken_words(*source_schedule.mix(documents([(1, None), (2, " ")])))
    assert [(r["size"], r.taken, r.target) for r in blank.collect()] == [(0, 0, 0.0)] * 2


def test_rows_without_id(documents):
    rows = [(None, f"a{i % 5} b", None, "s" if i % 2 else None) for i in range(40)]
    rows += [(i, "c d e " * 4000, None, "s") for i in range(4)]
    segments, sizes = source_schedule.mix(documents(rows), block=16)
    got = source_schedule.taken_words(segments, sizes).collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter(
        [(None, 2)] * 40 + [(i, 12000) for i in range(4)]
    )
    # The null source has a cap of 2 * 40 words, taken twice each.
    assert sum(r.taken for r in got if r.target == 80.0) == 80
    total = sum(r["size"] for r in got)
    assert 1.5 * total - 2 <= sum(r.taken for r in got) <= 1.5 * total
    frame = documents(rows).selectExpr("*", "1 AS named", "2 AS row", "3 AS copy", "4 AS document")
    mixed = source_schedule.mixed_documents(frame, block=16)
    assert mixed.columns == frame.columns
    counts = Counter((r.doc_id, r.source) for r in mixed.collect())
    assert counts[None, None] == 40 and sum(counts.values()) > 60


def test_many_sources(spark):
    n = 3000
    rows = [(f"s{i:05}", i, 500, 100.0 * (1 + i % 7)) for i in range(n)]
    frame = spark.createDataFrame(
        rows, "source string, position int, source_size long, target double"
    )
    sums = source_schedule.schedule(frame, 100).groupBy("source").agg(F.sum("words").alias("w"))
    assert {r.source: r.w for r in sums.collect()} == {s: int(t) for s, _, _, t in rows}


def test_mixed_documents(documents):
    rng = random.Random(3)
    rows = [*_rows(rng, 200), (1, "other text", None, "a")]
    frame = documents(rows)
    mixed = source_schedule.mixed_documents(frame)
    assert mixed.columns == frame.columns
    got = mixed.collect()
    whole = {(r[0], r[1], r[3]) for r in rows}
    counts = defaultdict(int)
    for r in got:
        assert (r.doc_id, r.text, r.source) in whole
        counts[r.doc_id, r.text] += 1
    assert max(counts.values()) == 2
    words = sum(len(r.text.split()) for r in got)
    total = sum(len((r[1] or "").split()) for r in rows)
    assert 1.5 * total <= words <= 1.5 * total + 6 * 300
