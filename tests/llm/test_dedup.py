"""Chunks and lines."""

import random

import numpy as np
import pytest

from marketloom.llm import chunk_dedup, winnow_lines


def _prose(rng, n):
    return " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(10**6)}é" for _ in range(n))


def _plain_cuts(raw):
    """The rule, byte by byte."""
    ends, last, wish = [], 0, []
    for i in range(len(raw)):
        h = 0
        for byte in raw[max(0, i - 15) : i + 1]:
            h = (h * 2 + int(chunk_dedup.GEAR[byte])) % 2**32
        whole = i + 1 == len(raw) or raw[i + 1] & 0xC0 != 0x80
        if whole and (h >> chunk_dedup.CUT_SHIFT) & chunk_dedup.CUT_BITS == 0:
            wish.append(i + 1)
    for cut in [*wish, len(raw)]:
        while cut - last > chunk_dedup.MOST:
            last += chunk_dedup.MOST
            while last < len(raw) and raw[last] & 0xC0 == 0x80:
                last -= 1
            ends.append(last)
        if cut - last >= chunk_dedup.LEAST:
            last = cut
            ends.append(cut)
    return ends + ([len(raw)] if last < len(raw) else [])


@pytest.mark.parametrize("text", ["", "a", "é" * 400, "a" * 1000, _prose(random.Random(1), 200)])
def test_cuts(text):
    raw = text.encode()
    got = chunk_dedup.cuts(np.frombuffer(raw, np.uint8))
    assert got == _plain_cuts(raw)
    begins = [0, *got[:-1]]
    assert "".join(raw[a:b].decode() for a, b in zip(begins, got)) == text


def test_repeated_passage_is_found_after_an_insertion(documents):
    rng = random.Random(2)
    passages = [_prose(rng, 60) for _ in range(20)]
    rows, planted = [], []
    for i, passage in enumerate(passages):
        rows.append((i, f"{_prose(rng, 50)} {passage} {_prose(rng, 40)}"))
        head = _prose(rng, 30 + i)
        rows.append((100 + i, f"{head} {passage} {_prose(rng, 20)}"))
        planted.append((100 + i, len(head), len(head) + len(passage)))
    rows += [(200 + i, _prose(rng, 120)) for i in range(20)]
    spans = chunk_dedup.repeated_spans(documents(rows)).collect()
    found = {r.doc_id: r for r in spans}
    assert set(found) == {d for d, _, _ in planted}
    for doc_id, start, end in planted:
        own = found[doc_id]
        assert own.first_doc_id == doc_id - 100
        assert start - 4 <= own.start and own.end <= end + 4
        assert own.end - own.start > 0.5 * (end - start)


def test_copies_lose_all_but_the_first(documents):
    rng = random.Random(3)
    text = _prose(rng, 100)
    frame = documents([(2, text), (1, text), (3, _prose(rng, 50)), (4, None), (5, ""), (None, text)])
    kept = {r.doc_id: r.text for r in chunk_dedup.deduplicated(frame).collect()}
    assert kept[1] == text and kept[2] == "" and kept[4] is None and kept[5] == ""
    assert kept[None] == text and len(kept[3]) > 0
    assert chunk_dedup.repeated_spans(documents([])).collect() == []


def test_short_whole_copies_are_found(documents):
    rng = random.Random(5)
    short = {n: _prose(rng, 20)[:n] for n in (1, 20, 50, 95)}
    cjk = "".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(90))
    texts = [*short.values(), cjk]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t) for i, t in enumerate(texts)]
    # Another version of a copy, and a long text that holds a short one, stay.
    other = _prose(rng, 40)
    rows += [(101, other), (200, f"{_prose(rng, 30)} {short[95]} {_prose(rng, 30)}")]
    frame = documents(rows)
    found = {tuple(r)[:4] for r in chunk_dedup.repeated_spans(frame).collect()}
    assert found == {(100 + i, 0, len(t), i) for i, t in enumerate(texts)}
    kept = {(r.doc_id, r.text) for r in chunk_dedup.deduplicated(frame).collect()}
    gone = {(100 + i, "") for i in range(len(texts))}
    assert kept == {r for r in rows if not 100 <= r[0] < 200} | gone | {(101, other)}


def test_texts_of_one_id_keep_what_is_theirs(documents):
    """A copy under a repeated id goes; the other texts of that id stay whole."""
    rng = random.Random(8)
    copied, clean = _prose(rng, 100), [_prose(rng, 120) for _ in range(3)]
    rows = [(1, copied), (2, copied), *((2, text) for text in clean)]
    frame = documents([*rows, (2, clean[0])])
    for name in ("__id", "__spans", "spans", "version", "doc", "total"):
        frame = frame.selectExpr("*", f"'{name}' AS `{name}`")
    out = chunk_dedup.deduplicated(frame)
    assert out.columns == frame.columns
    kept = sorted((r.doc_id, r.text) for r in out.collect())
    assert kept == sorted([(1, copied), (2, ""), *((2, t) for t in clean), (2, clean[0])])


def test_a_very_long_copy_goes(documents):
    text = _prose(random.Random(9), 150_000)
    rows = [(1, text), (2, "x" + text[:-40_000] + "y")]
    (span,) = chunk_dedup.repeated_spans(documents(rows)).collect()
    assert span.doc_id == 2 and span.end - span.start > len(text) - 40_000 - 300


def test_spans_point_at_equal_text(documents):
    rng = random.Random(4)
    shared = _prose(rng, 80)
    rows = {1: _prose(rng, 10) + shared, 2: shared + _prose(rng, 30), 3: "ü" * 5000, 4: "ü" * 5000}
    for r in chunk_dedup.repeated_spans(documents(list(rows.items()))).collect():
        span = rows[r.doc_id][r.start : r.end]
        assert len(span) == r.end - r.start >= chunk_dedup.MIN_CHARS
        assert any(span in t for d, t in rows.items() if d != r.doc_id) or r.doc_id == 3


def _brute_lines(rows, window, words):
    """Lines removed by comparing all runs of any length in order of (doc_id, place)."""
    seen, removed = set(), {}
    for doc_id, text in sorted(rows):
        lines = [(i, x.strip(" \t\r")) for i, x in enumerate(text.split("\n"))]
        lines = [x for x in lines if x[1]]
        gone = set()
        for at in range(len(lines)):
            for end in range(at + 1, len(lines) + 1):
                run = tuple(x for _, x in lines[at:end])
                whole = len(run) == len(lines)
                held = sum(len(x.split()) for x in run)
                if len(run) < window and held < words and not whole:
                    continue
                if run in seen:
                    gone |= {i for i, _ in lines[at:end]}
                seen.add(run)
        if gone:
            removed[doc_id] = sorted(gone)
    return removed


@pytest.mark.parametrize(("window", "words"), [(2, 99), (3, 99), (4, 99), (3, 10), (4, 5), (1, 9)])
def test_lines_equal_brute_force(documents, window, words):
    rng = random.Random(window)
    rows = []
    for i in range(80):
        lines = [
            f" line {'and ' * rng.choice((0, 0, 1, 3, 9))}{rng.randrange(12)} "
            for _ in range(rng.randrange(15) if i % 3 else rng.randrange(3))
        ]
        lines = [x if rng.random() < 0.9 else "" for x in lines]
        rows.append((i, "\n".join(lines)))
    got = winnow_lines.repeated_lines(documents(rows), window, words).collect()
    assert {r.doc_id: r.removed for r in got} == _brute_lines(rows, window, words)


def test_a_long_line_and_a_short_document_go(documents):
    rng = random.Random(6)
    line = _prose(rng, 50)
    rows = [
        (1, f"{_prose(rng, 12)}\n{line}\n{_prose(rng, 12)}"),
        (2, f"{_prose(rng, 12)}\n{line}\n{_prose(rng, 12)}"),
        (3, "two words"),
        (4, "\ntwo words "),
        (5, f"two words\n{_prose(rng, 12)}"),
    ]
    kept = {r.doc_id: r for r in winnow_lines.deduplicated(documents(rows)).collect()}
    assert {i: r["__removed"] for i, r in kept.items()} == {1: None, 2: [1], 3: None, 4: [1], 5: None}
    assert kept[2].text == "\n".join(x for x in rows[1][1].split("\n") if x != line)


def test_lines_of_very_long_texts_and_clashing_columns(documents):
    rng = random.Random(7)
    lines = [_prose(rng, 4) for _ in range(50_000)]
    frame = documents([(1, "\n".join(lines)), (2, "\n".join(lines[20_000:30_000]) + "\nnew")])
    for name in ("__id", "__version", "__removed", "__gone", "version", "removed", "doc", "words"):
        frame = frame.selectExpr("*", f"'{name}' AS `{name}`")
    kept = winnow_lines.deduplicated(frame)
    assert kept.columns == [*frame.columns, "___removed"]
    one, two = kept.orderBy("doc_id").collect()
    assert one.text == "\n".join(lines) and two.text == "new"
    assert two["___removed"] == list(range(10_000)) and two["__removed"] == "__removed"


def test_lines_odd_rows(documents):
    text = "a\nb\nc\nd"
    rows = [
        (1, text),
        (2, "x\n\na\n b\t\nc\nd\ny"),
        (3, None),
        (4, ""),
        (None, text),
        (5, "\n".join(["same"] * 5)),
        (6, "a\nb"),
        (2, "x\n\na\n b\t\nc\nd\ny"),
    ]
    frame = documents(rows)
    kept = winnow_lines.deduplicated(frame)
    assert kept.drop("__removed").columns == frame.columns
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert texts == {1: text, 2: "x\n\ny", 3: None, 4: "", None: text, 5: "same", 6: "a\nb"}
    assert kept.count() == len(rows)
    assert winnow_lines.deduplicated(documents([])).collect() == []


def test_windows_select_alike():
    """Lines of a run found elsewhere are selected there as well."""
    rng = np.random.default_rng(1)
    for _ in range(50):
        hashes = rng.integers(0, 40, 30)
        counts = hashes % 7
        own = winnow_lines.windows(np.array([0, 30]), counts, 4, 9)
        mine = {tuple(hashes[a : b + 1]) for a, b in zip(*own)}
        other = np.concatenate([rng.integers(0, 40, 9), hashes[5:25], rng.integers(0, 40, 9)])
        firsts, lasts = winnow_lines.windows(np.array([0, len(other)]), other % 7, 4, 9)
        inside = [(a, b) for a, b in zip(firsts, lasts) if a >= 9 and b < 29]
        assert inside and all(tuple(other[a : b + 1]) in mine for a, b in inside)
        assert {i for a, b in inside for i in range(a, b + 1)} == set(range(9, 29))
        for a, b, at in zip(firsts, lasts, winnow_lines.selected(other, firsts, lasts)):
            assert a <= at <= b and other[at] == other[a : b + 1].min()
