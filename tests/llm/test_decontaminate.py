import random
import re

from marketloom.llm import decontaminate


def _text(rng, n, size=400):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def _brute(documents, items, threshold):
    def shingles(text):
        words = re.findall(r"[^\W_]+", (text or "").lower())
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    out = set()
    for doc_id, text in documents:
        have = shingles(text)
        for item_id, item in items:
            own = shingles(item)
            if own and len(own & have) >= threshold * len(own):
                out.add((doc_id, item_id, len(own & have), len(own)))
    return out


def _pairs(spark, documents, rows, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(documents(rows), benchmark).collect()
    return [(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in found]


def test_equals_brute_force(spark, documents):
    rng = random.Random(1)
    items = [(i, " ".join(_text(rng, rng.choice([3, 5, 6, 9, 20, 60, 150])))) for i in range(60)]
    rows = []
    for i in range(80):
        words = _text(rng, rng.randrange(10, 900))
        for _ in range(rng.randrange(1, 3)):
            passage = rng.choice(items)[1].split()
            for _ in range(rng.randrange(3)):
                passage[rng.randrange(len(passage))] = "changed"
            at = rng.randrange(len(words))
            words[at:at] = passage
        rows.append((i, " ".join(words)))
    got = _pairs(spark, documents, rows, items)
    assert set(got) == _brute(rows, items, 0.8) and len(got) == len(set(got)) > 40


def test_blocks_of_items_give_the_same(spark, documents, monkeypatch):
    rng = random.Random(2)
    items = [(i, " ".join(_text(rng, 30))) for i in range(20)]
    rows = [(i, " ".join(_text(rng, 20)) + " " + items[i][1]) for i in range(20)]
    whole = sorted(_pairs(spark, documents, rows, items))
    monkeypatch.setattr(decontaminate, "BLOCK_SHINGLES", 100)
    assert sorted(_pairs(spark, documents, rows, items)) == whole
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    clean = documents([*rows, (50, "nothing of it"), (None, items[3][1]), (51, None)])
    kept = decontaminate.decontaminated(clean, benchmark)
    assert kept.columns == clean.columns
    assert sorted(r.doc_id for r in kept.collect()) == [50, 51]


def test_odd_rows(spark, documents):
    item = "one two three four five six seven"
    items = [(1, item), (2, None), (3, ""), (4, "one two"), (None, item), (1, item)]
    rows = [(1, f"x {item.upper()}!"), (2, None), (3, ""), (1, f"x {item}"), (4, "a " * 30_000 + item)]
    got = _pairs(spark, documents, rows, items)
    assert sorted(got, key=str) == sorted([(1, 1, 3, 3)] * 4 + [(1, None, 3, 3)] * 2 + [(4, 1, 3, 3)] * 2 + [(4, None, 3, 3)], key=str)
    assert _pairs(spark, documents, [], items) == []
    assert _pairs(spark, documents, rows, []) == []
