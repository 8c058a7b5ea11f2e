import math
import random
import zlib
from collections import defaultdict

import pytest

from marketloom.llm import ppm_language

WORDS = {
    "en": "the of and to in is that it was for with as his on be at by".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im".split(),
    "fr": "de la le et les des en un du une que est pour qui dans".split(),
}


def _rows(rng, n):
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(WORDS))
        rows.append((i, " ".join(rng.choices(WORDS[lang], k=rng.randrange(3, 40))), lang))
    return rows


def _lengths(learned, text, order):
    """PPM code lengths by definition, from plain counts."""
    counts = defaultdict(lambda: defaultdict(lambda: defaultdict(int)))
    for _, t, lang in learned:
        raw = t.lower().encode()
        for i, byte in enumerate(raw):
            for k in range(min(i, order) + 1):
                counts[lang][raw[i - k : i]][byte] += 1
    out = {}
    for lang in counts:
        raw, bits = text.lower().encode(), 0.0
        for i, byte in enumerate(raw):
            k = min(i, order)
            while True:
                seen = counts[lang].get(raw[i - k : i])
                if seen:
                    total, kinds = sum(seen.values()), len(seen)
                    if byte in seen:
                        bits -= math.log2(seen[byte] / (total + kinds))
                        break
                    bits -= math.log2(kinds / (total + kinds))
                if k == 0:
                    bits += 8
                    break
                k -= 1
        out[lang] = bits
    return out


def test_code_lengths_equal_the_definition(documents, monkeypatch):
    monkeypatch.setattr(ppm_language, "CHUNK", 37)
    rng = random.Random(1)
    rows = _rows(rng, 30)
    model = ppm_language.learn(documents(rows), order=3)
    texts = ["the zoo of ß", "x", "", "und " * 20, "ÉÉ 日本", rows[3][1]]
    got = model.lengths(texts)
    for text, bits in zip(texts, got, strict=True):
        expected = _lengths(rows, text, 3)
        assert model.languages == sorted(expected)
        assert bits == pytest.approx([expected[x] for x in model.languages])


def test_held_out_accuracy(documents):
    rng = random.Random(2)
    rows = _rows(rng, 300)
    got = ppm_language.language_of(documents(rows)).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    right = sum(r.lang_pred == rows[r.doc_id][2] for r in held)
    assert right / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_prediction_ignores_labels_of_held_out(documents):
    rng = random.Random(3)
    rows = _rows(rng, 80)
    wrong = [
        (i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows
    ]
    a, b = (
        {r.doc_id: (r.lang_pred, r.score) for r in ppm_language.language_of(documents(x)).collect()}
        for x in (rows, wrong)
    )
    assert a == b


def test_odd_rows(documents):
    rng = random.Random(4)
    rows = [*_rows(rng, 40), (900, None), (901, ""), (902, "12 !?"), (903, "the of", None), (None, "la le", "de")]
    rows += [(904, "the and of " * 30_000), (900, None)]
    frame = documents(rows)
    got = {r.doc_id: r for r in ppm_language.language_of(frame).collect()}
    for i in (900, 901, 902):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    assert got[903].lang_pred == got[904].lang_pred == "en" and not got[None].held_out
    kept = ppm_language.identified(frame)
    assert kept.columns == frame.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == 43 and not {900, 901, 902} & set(ids)
    assert ppm_language.language_of(documents([])).collect() == []
    alone = ppm_language.language_of(documents([(1, "abc")])).collect()
    assert [(r.lang_pred, r.score) for r in alone] == [("und", 0.0)]


def test_sample_is_bounded(documents):
    rng = random.Random(5)
    rows = _rows(rng, 200)
    small = ppm_language.learn(documents(rows), sample=5)
    whole = ppm_language.learn(documents(rows))
    assert small.languages == whole.languages
    assert len(small.grams[5]) < len(whole.grams[5])
    few = ppm_language.learn(documents(rows), sample_bytes=2000)
    assert few.languages and len(few.grams[5]) < len(whole.grams[5])


def test_identified_fills_languages_and_keeps_any_columns(documents):
    rng = random.Random(6)
    rows = [*_rows(rng, 80), (900, "the and of the and of"), (901, "12")]
    frame = documents(rows).selectExpr("*", "1 AS letters", "2 AS lang_pred", "3 AS score")
    kept = ppm_language.identified(frame)
    assert kept.columns == frame.columns
    got = {r.doc_id: r for r in kept.collect()}
    assert got[900].lang == "en" and got[900].lang_pred == 2 and 901 not in got
    assert all(got[i].lang == lang for i, _, lang in rows[:80])
    bare = documents([(1, "abc"), (2, "--"), (3, None)])
    assert [r.doc_id for r in ppm_language.identified(bare).collect()] == [1]


SHORT = ["", "a", "De", "De.", "abcd", "Avec.", "Éaux.", "日", "é."]


def test_short_texts_are_learned_and_scored_like_others(documents):
    rows = [(i, text, lang) for i, (text, lang) in enumerate((t, x) for t in SHORT for x in ("de", "fr"))]
    rows += [(100, "la vie de", "fr")]
    for order in (1, 4, 6):
        model = ppm_language.learn(documents(rows), order=order)
        for text in SHORT[1:]:
            expected = _lengths(rows, text, order)
            bits = model.lengths([text])[0]
            assert bits == pytest.approx([expected[x] for x in model.languages])


def test_texts_longer_than_all_that_was_learned(documents):
    for learned in (["a"], ["ab", "De."], ["a", "De.", "abcd"]):
        rows = [(i, text, "de" if i else "en") for i, text in enumerate(learned)]
        model = ppm_language.learn(documents(rows))
        for text in ["hello world", "De.", "日本語", "ab"]:
            expected = _lengths(rows, text, ppm_language.ORDER)
            bits = model.lengths([text])[0]
            assert bits == pytest.approx([expected[x] for x in model.languages])
    got = ppm_language.language_of(documents([(1, "De.", "de"), (3, "Von allen", None)])).collect()
    assert {r.lang_pred for r in got} == {"de"}
