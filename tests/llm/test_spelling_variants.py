import random
import zlib
from collections import Counter

import numpy as np
import pytest

from marketloom.llm import spelling_variants as sv


def edited(rng, word):
    i = rng.randrange(len(word) + 1)
    letter = rng.choice("abcdefgéß")
    kind = rng.randrange(3)
    return word[:i] + ("" if kind == 0 else letter) + word[i + (kind != 1) :]


def vocabulary(rng, size, letters="abcdefghijéèçüß", least=5, most=9):
    words = set()
    while len(words) < size:
        word = "".join(rng.choices(letters, k=rng.randint(least, most)))
        words.add(word)
        for _ in range(rng.randrange(3)):
            if len(changed := edited(rng, word)) >= 5:
                words.add(changed)
    return sorted(words)


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def brute(counts):
    words = sorted(counts)
    beside = {w: [v for v in words if near(w, v)] for w in words}
    forms = {}
    for w, others in beside.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best and counts[best] >= 2 * counts[w] else None
    rows = {}
    for w in words:
        root = w
        while forms[root]:
            root = forms[root]
        form = forms[w]
        rows[w] = (counts[w], len(beside[w]), form, form and counts[form], root)
    return rows


def collected(frame):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in frame.collect()}


@pytest.mark.parametrize(
    "limits", [{}, {"shard_words": 40, "visitors": 25}], ids=["whole", "split"]
)
def test_variants_equal_brute_force(spark, limits):
    rng = random.Random(1)
    words = vocabulary(rng, 500) + ["aaaab" + "x" * 300, "aaaab" + "x" * 301]
    # Words of the same letters share a leaf, however deep the trie is.
    words += ["".join(rng.sample("abcdefgh", 8)) for _ in range(150)]
    counts = Counter({w: rng.choice([3, 4, 6, 9, 20, 50]) for w in dict.fromkeys(words)})
    rows = [(-1, w) for w, n in counts.items() for _ in range(n)]
    # A document without letters in its number's checksum: take ids whose words stay whole.
    rows = [(next(i for i in range(999) if zlib.crc32(f"{i}:{w}".encode()) % 97), w) for _, w in rows]
    frame = spark.createDataFrame([(i, w, "x") for i, w in rows], "doc_id long, text string, n string")
    assert collected(sv.variants(frame, **limits)) == brute(counts)


def test_words_are_damaged_by_their_checksum(spark, documents):
    rng = random.Random(2)
    texts = {i: " ".join(rng.choices(["Häuser", "ÉCOLE", "straße", "naïve-té", "x2words"], k=40)) for i in range(60)}
    rows = [*texts.items(), (7, texts[7]), (None, "Wörter Wörter Wörter"), (99, None), (98, "")]
    expected = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    letter = {chr(c) for c in (*range(65, 91), *range(97, 123), *range(0xC0, 0x100))}
    for doc_id, text in rows:
        runs = "".join(c if c in letter else " " for c in text or "").split()
        for run in runs:
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            expected[run if h % 97 else run[:at] + run[at + 1 :]] += 1
    expected = {w: n for w, n in expected.items() if len(w) >= 5 and n >= 3}
    got = {r.word: r.n for r in sv.words(documents(rows)).collect()}
    assert got == expected and len(got) > 4


def test_one_edit_and_trie(rng=random.Random(3)):
    words = vocabulary(rng, 300, "abcé", 5, 7)
    by_length = {n: [w for w in words if len(w) == n] for n in range(5, 9)}
    for n in range(5, 8):
        for more in (0, 1):
            short, long = by_length[n], by_length[n + more]
            got = {
                (short[i], long[j])
                for x, y in sv.near_pairs(long, short)
                for i, j in zip(x.tolist(), y.tolist())
            }
            assert got == {(a, b) for a in short for b in long if near(a, b)}


def test_the_trie_visits_few_words():
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghijklmnopqrst", k=9)) for _ in range(3000)]
    vectors = sv.letter_counts(sv._codes(words))
    trie = sv.Trie(vectors)
    visited = sum(len(who) for who, _ in trie.search(vectors))
    assert visited < len(words) ** 2 / 100


def test_reachable_shards_cover_every_edit():
    rng = random.Random(5)
    deltas = set(sv.reachable(4))
    for word in vocabulary(rng, 300):
        changed = edited(rng, word)
        short, long = sorted((word, changed), key=len)
        if short != long and near(short, long):
            one, two = (np.bincount(sv.GROUP_OF[list(map(ord, w))], minlength=12) for w in (short, long))
            assert (len(long) - len(short), *(two - one)[:4]) in deltas


def test_empty_tables(spark, documents):
    assert sv.variants(documents([])).collect() == []
    assert sv.variants(documents([(1, "one word"), (2, None)])).collect() == []
