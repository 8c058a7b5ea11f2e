import hashlib
import random
import re

from marketloom.llm import pii_patterns

FIXED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _good(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and _luhn(digits)
    return kind != "phone" or 9 <= len(digits) <= 15


def _base(text):
    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern in FIXED.items()
        for m in re.finditer(pattern, text or "")
        if _good(kind, m.group())
    ]


def _check(documents, texts, **options):
    rows = list(enumerate(texts))
    got = pii_patterns.summary(documents(rows), **options).collect()
    assert len(got) == len(rows)
    for r in got:
        base = _base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        counts = [sum(x.startswith(kind) for x in base) for kind in FIXED]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts
        spans = r.spans.split(",") if r.spans else []
        assert set(base) <= set(spans) and len(spans) == len(base) + r.n_added
        assert spans == sorted(spans, key=lambda x: (list(FIXED).index(x.split(":")[0]), int(x.split(":")[1])))
    return {r.doc_id: r for r in got}


PIECES = [
    *("a@b.c", "x_y@d-e.f.g", "@", ".", "1.2.3.4", "256.1.1.1", "001.02.3.255", "5.6.7.8.9", " ", "😀", "é"),
    *("4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (743) 555-3824", "+", "-", "(", "7", "%", "_", "\n", "abc"),
]


def test_base_spans_equal_the_patterns(documents):
    rng = random.Random(1)
    texts = ["".join(rng.choices(PIECES, k=rng.randrange(14))) for _ in range(1500)]
    _check(documents, texts)


def test_odd_rows(documents):
    long = ["1 " * 40_000, "a" * 200_000, "1" * 100_000, "a@" * 50_000, "+1" + "(" * 100_000, "1." * 50_000]
    texts = [None, "", "no data", *long]
    got = _check(documents, texts)
    assert got[0].spans == ""
    rows = [(1, "a@b.c"), (1, "a@b.c"), (1, "x a@b.c"), (None, "a@b.c")]
    found = pii_patterns.summary(documents(rows)).collect()
    assert sorted((r.doc_id or 0, r.spans) for r in found) == [
        (0, "email:0:5"),
        (1, "email:0:5"),
        (1, "email:0:5"),
        (1, "email:2:7"),
    ]
    assert pii_patterns.summary(documents([])).collect() == []


def test_contexts_discover_unseen_identifiers(documents):
    rng = random.Random(2)
    texts = []
    for i in range(40):
        number = f"+49 30 {rng.randrange(10**6, 10**7)}"
        texts.append(f"Bitte Rückruf unter Rufnummer {number} heute {rng.randrange(100)} mal")
    texts += ["Ihre Rufnummer 030/1234567 heute", "am 24.12. heute", "Seite 17 von 30"]
    got = _check(documents, texts)
    text = texts[40]
    at = text.index("030/")
    assert got[40].spans == f"phone:{at}:{at + 11}"
    assert got[41].spans == got[42].spans == ""
    assert all(got[i].n_added == 0 for i in range(40))


def _word(rng):
    return "".join(rng.choices("abcdefghijklmnop", k=7))


def test_one_side_is_enough_where_the_other_varies(documents):
    rng = random.Random(3)

    def number():
        return f"+49 30 {rng.randrange(10**6, 10**7)}"

    texts = [f"{_word(rng)} Rufnummer {number()} {_word(rng)}" for _ in range(40)]
    texts += [f"{_word(rng)} {number()} anrufen" for _ in range(40)]
    # The word after the first is rare, common after other numbers, or missing.
    texts += [f"um {n} und {n} und {_word(rng)}" for n in range(100)]
    first = len(texts)
    texts += ["Ihre Rufnummer 030/1234567 selten", "Ihre Rufnummer 030/2345678 und", "Rufnummer 030/3456789"]
    texts += ["bitte 030/4567890 anrufen"]
    texts += ["am 24.12. heute", "um 24 und"]
    got = _check(documents, texts)
    for i in range(first, first + 4):
        at = texts[i].index("030/")
        assert got[i].spans == f"phone:{at}:{at + 11}"
    assert [got[first + 4].n_added, got[first + 5].n_added] == [0, 0]


def test_contexts_sure_of_two_kinds_mark_nothing(documents):
    rng = random.Random(4)
    texts = []
    for i in range(40):
        texts.append(f"{_word(rng)} Rufnummer +49 30 {rng.randrange(10**6, 10**7)} {_word(rng)}")
        texts.append(f"{_word(rng)} x{i}@y.z schreiben")
    texts += ["Rufnummer 030/1234567 schreiben", "Rufnummer 030/1234567 nun"]
    got = _check(documents, texts)
    assert got[80].n_added == 0 and got[81].n_added == 1
