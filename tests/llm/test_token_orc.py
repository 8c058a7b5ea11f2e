import random
import zlib

import numpy as np
import pytest

from marketloom.llm import token_orc


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(token_orc.tokenizer_path())


ALPHABET = [
    *("a", "foo", " ", "  ", "\n", "\t", "<|endoftext|>", ".", "é", "'s", "'LL", "1", "\x1c", "　"),
    *("日本", "😀", "​", "\x85", "᠎", "٣", "²", "Ⅷ", "́", "𝒜", "\U0001f9ff", "\x00", "\xa0"),
]


def test_ids_equal_the_whole_pipeline(tokenizer):
    rng = random.Random(1)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randrange(25))) for _ in range(5000)]
    got = token_orc.Encoder(token_orc.tokenizer_path()).encode(texts)
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_kept_pretokens_are_bounded(tokenizer, monkeypatch):
    monkeypatch.setattr(token_orc, "CACHED_PIECES", 20)
    encoder = token_orc.Encoder(token_orc.tokenizer_path())
    for i in range(30):
        (ids,) = encoder.encode([text := f"the word{i} and other{i} words"])
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text).ids
    assert len(encoder.pretokens) == len(encoder.runs) == 20


def test_files_hold_every_document_in_order(spark, documents, tokenizer, tmp_path):
    rng = random.Random(2)
    rows = [(i * 7 % 101, "word " * rng.randrange(40) + str(i)) for i in range(100)]
    rows += [(500, None), (501, ""), (502, "x y " * 20_000), (7, "again"), (None, "no id")]
    path = token_orc.write_tokens(documents(rows), str(tmp_path / "ids"), partitions=5)
    tokens = token_orc.read_tokens(spark, path)
    got = sorted(token_orc.checksums(tokens).collect(), key=lambda r: r.start)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] or ""))
    assert [r.doc_id for r in got] == [r[0] for r in ordered]
    start = 0
    for r, (_, text) in zip(got, ordered, strict=True):
        ids = [*tokenizer.encode(text or "").ids, 0]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), crc)
        start += len(ids)


def test_readers_skip_by_metadata(spark, documents, tmp_path):
    rows = [(i, f"text {i}") for i in range(4000)]
    path = token_orc.write_tokens(documents(rows), str(tmp_path / "ids"), partitions=4)
    found = token_orc.read_documents(spark, path, [17, 3999])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "In(doc_id, [17,3999])" in plan.split("PushedFilters: ")[1]
    assert sorted(r.doc_id for r in found.collect()) == [17, 3999]
    read = found.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).sum()
    assert read == 2


def test_empty_table(spark, documents, tmp_path):
    path = token_orc.write_tokens(documents([]), str(tmp_path / "ids"))
    assert token_orc.checksums(token_orc.read_tokens(spark, path)).collect() == []


def test_plain_lines_are_split_at_single_spaces(tokenizer, monkeypatch):
    encoder = token_orc.Encoder(token_orc.tokenizer_path())
    plain = ["two plain lines, here.\nAnd été\n more; x\n", " a b's 12%%%\nc", "\nfoo bar"]
    others = ["a  b", "a \nb", "a\n\nb ", "a\n\n", "end ", "tab\tand　wide", "a \n\n b", "a\n  b"]
    got = encoder.encode([*plain, *others])
    for text, ids in zip([*plain, *others], got, strict=True):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
    # Words are held once, and plain texts need no search for runs.
    assert " plain" not in encoder.pretokens and "plain" in encoder.runs
    monkeypatch.setattr(token_orc, "RUNS", "(")
    assert encoder.encode(plain) == got[: len(plain)]
