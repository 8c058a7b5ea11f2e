"""The operators over the sample tables: one query each, and SQL where it can say the same."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import (
    chat_schema,
    chunk_dedup,
    conversation_repair,
    decontaminate,
    order_minhash,
    pii_patterns,
    pivot_topk,
    ppm_language,
    pruned_graph,
    source_schedule,
    spelling_variants,
    token_orc,
    winnow_lines,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near-duplicates of every document."""
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of all documents that repeat what stands earlier."""
    return chunk_dedup.repeated_spans(table(spark, sf_dir, "documents"))


def op3_winnow_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines removed from all documents, and a digest of what is left."""
    kept = winnow_lines.deduplicated(table(spark, sf_dir, "documents"))
    removed = F.coalesce(F.col("__removed"), F.array().cast("array<int>"))
    return kept.select(
        "doc_id",
        F.size(removed).cast("long").alias("n_removed"),
        F.array_join(removed.cast("array<string>"), ",").alias("removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op4_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents contain."""
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contaminated(documents, benchmark)


def op5_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids, written as ORC and read back."""
    return token_orc.tokenized(table(spark, sf_dir, "documents"))


def op6_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five greatest inner products of every fiftieth vector with all others."""
    vectors = table(spark, sf_dir, "embeddings")
    return pivot_topk.search(vectors, vectors.filter("vec_id % 50 = 0"))


def op7_pii_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii_patterns.summary(table(spark, sf_dir, "documents"))


def op8_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    return ppm_language.language_of(table(spark, sf_dir, "documents"))


TRAP = r"\### Assistant: </turn> ok"


def op9_chat_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of another layout, formatted and read back."""
    trap = json.dumps(
        {"messages": [{"role": role, "content": TRAP} for role in ("user", "assistant")]}
    )
    rows = chat_schema.turn_records(table(spark, sf_dir, "conversations"))
    extra = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"), F.parse_json(F.lit(trap)).alias("record")
    )
    return chat_schema.read_back(chat_schema.chat(rows.unionByName(extra)))


def op10_source_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix of all documents takes of each document."""
    segments, sizes = source_schedule.mix(table(spark, sf_dir, "documents"))
    return source_schedule.taken_words(segments, sizes)


def op11_spelling_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their spelling variants and roots."""
    return spelling_variants.variants(table(spark, sf_dir, "documents"))


def op12_audit_dp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of all damaged conversations, the edits that repair them and the result."""
    rows = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.repaired(rows)


def op13_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of near-duplicate vectors of one label."""
    return pruned_graph.near_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    build.__name__: build
    for build in (
        op1_order_minhash,
        op2_chunk_dedup,
        op3_winnow_lines,
        op4_containment,
        op5_token_orc,
        op6_pivot_topk,
        op7_pii_patterns,
        op8_ppm_language,
        op9_chat_schema,
        op10_source_schedule,
        op11_spelling_trie,
        op12_audit_dp,
        op13_pruned_graph,
    )
}

# The checksum of a list of bytes, by the usual table of 256 remainders.
CRC_TABLE = """
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda c, k: xor(c >> 1, 3988292384 * (c & 1)))) AS crc_table
"""
CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {}),
        lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])))"""


def _least(*offers: str) -> str:
    """The cheapest of (cost, edits), ties by edits."""
    return f"list_min([{', '.join(offers)}])"


def _more(state: str, cost: str, letter: str) -> str:
    return f"{{'c': {state}.c + {cost}, 's': {state}.s || '{letter}'}}"


def _audit_sql() -> str:
    stays = "fault NOT IN (1, 2)"
    own = {i: f"if(initial = '{i}' AND {stays}, cut, 1000000000)" for i in "sua"}
    given = f"if({stays}, 2 + cut, 1000000000)"
    before_user = [_more(x, own["u"], "K") for x in "nsa"] + [_more(x, given, "R") for x in "nsa"]
    steps = {
        "n": _more("n", "3", "D"),
        "s": _least(_more("s", "3", "D"), _more("n", own["s"], "K")),
        "u": _least(_more("u", "3", "D"), *before_user),
        "a": _least(_more("a", "3", "D"), _more("u", own["a"], "K"), _more("u", given, "R")),
    }
    user = _least("u", *[_more(x, "2", "I") for x in "nsa"])
    assistant = _least("a", _more("u", "2", "I"))
    stepped = ", ".join(f"{sql} AS {name}" for name, sql in steps.items())
    key = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
    crc = CRC.format(f"list_transform(string_split({key}, ''), lambda x: ascii(x)::BIGINT)")
    none = "{'c': 1000000000, 's': ''}"
    return rf"""
WITH RECURSIVE crc AS ({CRC_TABLE}), kinds AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {crc} % 20 AS kind
    FROM conversations, crc
), damaged AS (
    SELECT conv_id, turn, if(kind = 4, 'user', role) AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g')
               ELSE text END AS text,
           unnest(if(kind = 3, [0, 1], [0])) AS copy
    FROM kinds WHERE kind <> 0
), placed AS (
    SELECT *, row_number() OVER (
               PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
           rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
    FROM damaged
), faults AS (
    SELECT conv_id, turn, role, text, i, left(role, 1) AS initial,
           CASE WHEN bare = '' THEN 1
                WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
                WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
    FROM placed
), counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
           count(*) FILTER (fault = 3) AS truncated,
           count(*) FILTER (
               before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
           count(*) AS n
    FROM faults GROUP BY conv_id
), raw(conv_id, i, n, s, u, a) AS (
    SELECT conv_id, 0::BIGINT, {{'c': 0, 's': ''}}, {none}, {{'c': 2, 's': 'I'}},
           {{'c': 4, 's': 'II'}}
    FROM counts
    UNION ALL
    SELECT conv_id, i, n, s, u, {assistant}
    FROM (SELECT conv_id, i, n, s, {user} AS u, a
          FROM (SELECT raw.conv_id, f.i, {stepped}
                FROM raw JOIN (SELECT *, if(fault = 3, 1, 0) AS cut FROM faults) f
                  ON raw.conv_id = f.conv_id AND f.i = raw.i + 1))
), ends AS (
    SELECT conv_id, {_least("raw.n", "raw.a")} AS best
    FROM raw JOIN counts USING (conv_id) WHERE i = counts.n
), letters AS (
    SELECT conv_id, k, best.s[k] AS edit, k - length(replace(best.s[:k], 'I', '')) AS inserted,
           length(replace(best.s[:k], 'D', '')) AS place
    FROM (SELECT conv_id, best, unnest(range(1, length(best.s) + 1)) AS k FROM ends)
), joined AS (
    SELECT l.conv_id, k, edit, place, role, if(edit = 'I', '', text) AS text, initial
    FROM letters l LEFT JOIN faults f ON l.conv_id = f.conv_id AND f.i = k - inserted AND edit <> 'I'
    WHERE edit <> 'D'
), system AS (
    SELECT conv_id, count(*) AS s FROM joined
    WHERE place = 1 AND edit = 'K' AND initial = 's' GROUP BY conv_id
), lines AS (
    SELECT conv_id, string_agg(
               if(edit = 'K', role, if((place - coalesce(s, 0)) % 2 = 1, 'user', 'assistant'))
               || ':' || text, chr(10) ORDER BY k) AS text
    FROM joined LEFT JOIN system USING (conv_id) GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
       coalesce(best.s, '') AS audit,
       sha256(coalesce(lines.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN counts USING (conv_id)
LEFT JOIN ends USING (conv_id) LEFT JOIN lines USING (conv_id)
"""


RUN_BYTES = """flatten(list_transform(string_split(doc_id::VARCHAR || ':' || run, ''),
        lambda x: if(unicode(x) < 128, [unicode(x)::BIGINT], [195::BIGINT, unicode(x) - 64])))"""

ORACLES: dict[str, str] = {
    "op13_pruned_graph": """
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
), usable AS (
    SELECT vec_id, label, v FROM vectors
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL
      AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id, b.vec_id AS other
    FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
        AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reached(vec_id, other) AS (
    SELECT vec_id, other FROM links
    UNION
    SELECT reached.vec_id, links.other FROM reached JOIN links ON reached.other = links.vec_id
), degrees AS (
    SELECT vec_id, count(*) AS n_links FROM links GROUP BY vec_id
), least AS (
    SELECT vec_id, min(other) AS least FROM reached GROUP BY vec_id
)
SELECT vec_id, coalesce(n_links, 0) AS n_links,
       coalesce(least(vec_id, least), vec_id) AS component_id,
       coalesce(vec_id <= least, true) AS kept
FROM vectors LEFT JOIN degrees USING (vec_id) LEFT JOIN least USING (vec_id)
""",
    "op11_spelling_trie": rf"""
WITH RECURSIVE crc AS ({CRC_TABLE}), runs AS (
    SELECT doc_id, run, count(*) AS n
    FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
          FROM documents)
    WHERE length(run) >= 5 GROUP BY doc_id, run
), hashed AS (
    SELECT run, n, {CRC.format(RUN_BYTES)} AS h FROM runs, crc
), words AS (
    SELECT word, sum(n)::BIGINT AS n
    FROM (SELECT if(h % 97 = 0, run[:h % length(run)] || run[h % length(run) + 2:], run) AS word, n
          FROM hashed)
    WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cuts AS (
    SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
    SELECT a.word, b.word AS near, b.n AS near_n
    FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word
), best AS (
    SELECT word, count(*) AS n_near, list_min(list({{'less': -near_n, 'near': near}})) AS best
    FROM near GROUP BY word
), formed AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near,
           if(-best.less >= 2 * n, best.near, NULL) AS form,
           if(-best.less >= 2 * n, -best.less, NULL) AS form_n
    FROM words LEFT JOIN best USING (word)
), chain(word, root, further) AS (
    SELECT word, word, form FROM formed
    UNION ALL
    SELECT chain.word, f.word, f.form FROM chain JOIN formed f ON f.word = chain.further
)
SELECT word, n, n_near, form, form_n, root
FROM formed JOIN (SELECT word, root FROM chain WHERE further IS NULL) USING (word)
""",
    "op12_audit_dp": _audit_sql(),
    "op3_winnow_lines": r"""
WITH lines AS (
    SELECT doc_id, i - 1 AS i, parts[i] AS line, trim(parts[i], ' ' || chr(9) || chr(13)) AS bare
    FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i
          FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))
), numbered AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n, bare
    FROM lines WHERE bare <> ''
), counted AS (
    SELECT *, len(regexp_extract_all(bare, '[^\x20\x09-\x0D]+')) AS words
    FROM numbered
), near AS (
    SELECT doc_id, n, bare, words, lead(bare) OVER w AS bare1, lead(bare, 2) OVER w AS bare2,
           lead(words) OVER w AS words1, lag(words) OVER w AS words_before,
           lag(n, 2) OVER w IS NOT NULL AS has_two_before
    FROM counted WINDOW w AS (PARTITION BY doc_id ORDER BY n)
), sized AS (
    SELECT doc_id, n, bare, bare1, bare2,
           CASE WHEN words >= 10 THEN 1 WHEN words + words1 >= 10 THEN 2
                WHEN bare2 IS NOT NULL THEN 3 END AS ahead,
           CASE WHEN words >= 10 THEN 1 WHEN words + words_before >= 10 THEN 2
                WHEN has_two_before THEN 3 END AS behind
    FROM near
), short AS (
    SELECT doc_id, count(*) AS size FROM counted
    GROUP BY doc_id HAVING count(*) < 3 AND sum(words) < 10
), windows AS (
    SELECT doc_id, n, ahead AS size FROM sized WHERE ahead IS NOT NULL
    UNION
    SELECT doc_id, n - behind + 1, behind FROM sized WHERE behind IS NOT NULL
    UNION
    SELECT doc_id, 1, size FROM short
), runs AS (
    SELECT doc_id, n, size, CASE size WHEN 1 THEN bare WHEN 2 THEN bare || chr(10) || bare1
           ELSE bare || chr(10) || bare1 || chr(10) || bare2 END AS run
    FROM windows JOIN sized USING (doc_id, n)
), later AS (
    SELECT doc_id, n, size FROM (
        SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, n) AS place FROM runs)
    WHERE place > 1
), gone AS (
    SELECT DISTINCT doc_id, i FROM numbered JOIN (
        SELECT doc_id, n + unnest(range(size)) AS n FROM later) USING (doc_id, n)
), kept AS (
    SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text
    FROM lines LEFT JOIN gone USING (doc_id, i) WHERE gone.doc_id IS NULL GROUP BY doc_id
), lost AS (
    SELECT doc_id, count(*) AS n, string_agg(i::VARCHAR, ',' ORDER BY i) AS removed
    FROM gone GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_removed, coalesce(removed, '') AS removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
""",
    "op4_containment": r"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w
    FROM documents
), item_words AS (
    SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w
    FROM benchmark
), item_shingles AS (
    SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS shingle
    FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM item_words)
), doc_shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM doc_words)
), sizes AS (
    SELECT item_id, count(*) AS n_item FROM item_shingles GROUP BY item_id
)
SELECT doc_id, item_id, count(*) AS n_shared, n_item,
       count(*)::DOUBLE / n_item AS containment
FROM item_shingles JOIN doc_shingles USING (shingle) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, n_item
HAVING count(*) >= 0.8 * n_item - 1e-9
""",
    "op6_pivot_topk": """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
    FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op9_chat_schema": r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL
    SELECT -7, turn, role, '\### Assistant: </turn> ok'
    FROM (VALUES (0, 'user'), (1, 'assistant')) AS t(turn, role)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
           AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), ''))
           AS loss_sha256,
       CAST(sum(length(replace(replace(replace(role, '\', '\\'), '<', '\<'), '|', '\|'))
           + length(replace(replace(text, '\', '\\'), '<', '\<')) + 11) AS BIGINT)
           AS formatted_chars
FROM turns
GROUP BY conv_id
""",
}
