import hashlib
import heapq
import random

import pytest

from marketloom.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string, kind string, fault int, audit string"


def brute(rows):
    """The cheapest (cost, edits) by search over whole strings."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, edits, at, roles = heapq.heappop(heap)
        state = "".join(roles[-1:]) or "-"
        if at == len(rows) and (not roles or (state == "a")):
            return cost, edits
        if (at, state) in seen:
            continue
        seen.add((at, state))
        after = "a" if state == "u" else "u"
        heapq.heappush(heap, (cost + 2, edits + "I", at, roles + after))
        if at == len(rows):
            continue
        initial, fault = rows[at]
        heapq.heappush(heap, (cost + 3, edits + "D", at + 1, roles))
        if fault in (cr.BLANK, cr.DUPLICATE):
            continue
        extra = fault == cr.CUT
        if initial == after or (initial == "s" and state == "-"):
            heapq.heappush(heap, (cost + extra, edits + "K", at + 1, roles + initial))
        heapq.heappush(heap, (cost + 2 + extra, edits + "R", at + 1, roles + after))


@pytest.mark.parametrize("modulus", [cr.MODULUS, 3])
def test_audit_equals_brute_force(modulus):
    """Also with a hash of three values, whose collisions must be found."""
    rng = random.Random(1)
    for _ in range(1500):
        letters = rng.choice(["sua", "ua", "u", "a", "suat "])
        rows = [(rng.choice(letters), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(14))]
        audit = cr.Audit(modulus)
        for row in rows:
            audit.row(*row)
        assert audit.result() == brute(rows), rows


def test_prefixes_find_ancestors_and_common_beginnings():
    rng = random.Random(2)
    prefixes, texts = cr.Prefixes(5), [""]
    for _ in range(3000):
        parent = rng.randrange(max(0, len(texts) - 8), len(texts))
        letter = rng.choice("DI")
        prefixes.add(parent, letter)
        texts.append(texts[parent] + letter)
    for _ in range(3000):
        x, y = rng.randrange(len(texts)), rng.randrange(len(texts))
        a, b = texts[x], texts[y]
        common = next((i for i, (p, q) in enumerate(zip(a, b)) if p != q), min(len(a), len(b)))
        assert prefixes.common(x, y) == common
        depth = rng.randrange(len(a) + 1)
        assert prefixes.text(prefixes.at(x, depth)) == a[:depth]


def test_a_long_conversation_of_one_role():
    audit = cr.Audit()
    for _ in range(20_000):
        audit.row("u", 0)
    cost, edits = audit.result()
    # Every second row becomes the assistant's, by either edit at the same cost.
    assert cost == 20_000 and edits.count("I") + edits.count("R") == 10_000
    assert len(edits) - edits.count("I") == 20_000


def repaired(spark, rows, damage=False):
    frame = spark.createDataFrame([(*r, "x", 7, "y") for r in rows], SCHEMA)
    if damage:
        return cr.repaired(cr.damaged(frame)).collect()
    whole = frame.selectExpr(
        "conv_id", "turn", "coalesce(role, ' ') AS role", "coalesce(text, ' ') AS text",
        "0 AS copy", "false AS dropped",
    )
    return {r.conv_id: r for r in cr.repaired(whole).collect()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_repair_of_whole_rows(spark):
    long = "word " * 100_000 + "end."
    got = repaired(
        spark,
        [
            (1, 0, "user", "Hi."), (1, 1, "assistant", long),
            (2, 5, "user", "Same."), (2, 6, "user", "Same."), (2, 9, "assistant", "cut"),
            (3, None, "system", "Be."), (3, 1, "user", " \t\n"), (3, 1, "user", "Q?"),
            (4, None, None, None),
            (None, 1, "user", "No id."), (None, 1, "user", "No id."),
        ],
    )
    assert (got[1].audit, got[1].cost, got[1].illegal, got[1].gaps) == ("KK", 0, 0, 0)
    assert got[1].repaired_sha256 == sha(f"user:Hi.\nassistant:{long}")
    r = got[2]
    assert (r.audit, r.cost, r.gaps, r.duplicate, r.truncated, r.illegal) == ("KDK", 4, 2, 1, 1, 1)
    r = got[3]
    # Rows of one turn come in order of role and text, so the blank one is first.
    assert (r.audit, r.cost, r.gaps, r.blank, r.illegal) == ("KDKI", 5, 0, 1, 1)
    assert r.repaired_sha256 == sha("system:Be.\nuser:Q?\nassistant:")
    r = got[4]
    assert (r.audit, r.cost, r.blank, r.gaps, r.repaired_sha256) == ("D", 3, 1, 0, sha(""))
    assert got[None].duplicate == 1 and got[None].audit == "KDI"


def test_conversations_that_damage_empties_stay(spark):
    import zlib

    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    (r,) = repaired(spark, [(dropped, 0, "user", "Hi.")], damage=True)
    assert r == (dropped, 0, 0, 0, 0, 0, 0, "", sha(""))
    assert repaired(spark, [], damage=True) == []


def test_one_shuffle_for_the_search(spark):
    frame = spark.createDataFrame([(1, 0, "user", "Hi.", "x", 7, "y")], SCHEMA)
    plan = cr.audits(cr.damaged(frame))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
