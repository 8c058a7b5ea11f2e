"""Personal data by patterns and by bootstrapped contexts, in DataFrame functions only.

Seeds are matches of fixed patterns: e-mail and IP addresses, card and phone numbers. A
match's place follows from the lengths of what ``split`` leaves between matches, as running sums.

Around the seeds stand lexical patterns: the word before, the word after, and both together.
The instances of a pattern are the seeds and all other words with a digit or an at sign in
such a context. On that graph scores spread for each kind in rounds: a pattern's score is
the mean score of its instances, an instance's the mean score of its patterns; seeds keep 1
for their kind and 0 for others. Patterns of enough seeds and a high score are sure of their
kind. An unseen word is personal data of that kind if one of its patterns decides and none
is sure of another kind. A sure pattern decides, whatever its other patterns know: a label
stands before what it names, so the word before is enough. The word after alone is, where
seeds stand before it with enough different words ahead, or where no word is ahead.

All regular expressions take linear time: repetitions are possessive, and a match begins
where its run of characters begins or where the match before ended.

Cases: null and empty texts have no spans; rows that repeat a doc_id with the same text get
the same result each, with other texts their own; null doc_ids are a group of their own and
treated likewise; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketloom.llm.common import written

KINDS = ("email", "ip", "card", "phone")
LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Words that can be identifiers: those with a digit or an at sign.
WORDS = {"word": r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"}
CONTEXT = 48
ROUNDS, LEAST_SEEDS, LEAST_SCORE = 3, 5, 0.9
DOCUMENT = ["doc_id", "version"]


def _valid(kind: Column, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
    card = F.length(digits).between(13, 19) & F.call_function(
        "luhn_check", F.when(F.length(digits) <= 19, digits)
    )
    return (
        F.when(kind == "ip", found.rlike(rf"^{part}(?:\.{part}){{3}}$"))
        .when(kind == "card", card)
        .when(kind == "phone", F.length(digits).between(9, 15))
        .otherwise(F.lit(True))
    )


def located(documents: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """(doc_id, version, kind, start, end, found, before, after) of all matches.

    Places are code points, end exclusive; ``before`` and ``after`` are the nearest characters.
    """
    text = F.col("text")
    sets = [
        F.struct(
            F.lit(kind).alias("kind"),
            F.split(text, pattern, -1).alias("gaps"),
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
        )
        for kind, pattern in patterns.items()
    ]
    texts = documents.filter("text RLIKE '[0-9@]'").select(
        "doc_id", F.xxhash64("text").alias("version"), "text"
    )
    matched = texts.select(*DOCUMENT, F.inline(F.array(*sets))).filter(F.size("found") > 0)
    each = F.transform(
        "found",
        lambda match, i: F.struct(
            i.alias("i"),
            match.alias("found"),
            F.length(F.get("gaps", i)).alias("gap"),
            F.right(F.get("gaps", i), F.lit(CONTEXT)).alias("before"),
            F.left(F.get("gaps", i + 1), F.lit(CONTEXT)).alias("after"),
        ),
    )
    rows = matched.select(*DOCUMENT, "kind", F.inline(each)).dropDuplicates(
        [*DOCUMENT, "kind", "i"]
    )
    run = W.partitionBy(*DOCUMENT, "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.length("found")).over(run)
    return rows.withColumn("end", end).select(
        *DOCUMENT,
        "kind",
        (F.col("end") - F.length("found")).alias("start"),
        "end",
        "found",
        "before",
        "after",
    )


def base_spans(documents: DataFrame) -> DataFrame:
    """Matches of the fixed patterns that pass their kind's test."""
    return located(documents, PATTERNS).filter(_valid(F.col("kind"), F.col("found")))


def _contexts(matches: DataFrame) -> DataFrame:
    """One row for each lexical pattern around each match; words in lower case."""
    before = F.lower(F.regexp_extract("before", r"([\p{L}\p{N}=:_]+)[^\p{L}\p{N}\n]*$", 1))
    after = F.lower(F.regexp_extract("after", r"^[^\p{L}\p{N}\n]*([\p{L}\p{N}]+)", 1))
    left, right = F.nullif(before, F.lit("")), F.nullif(after, F.lit(""))
    around = F.array(
        F.concat(left, F.lit(" _")),
        F.concat(F.lit("_ "), right),
        F.concat(left, F.lit(" _ "), right),
    )
    known = F.filter(around, lambda p: p.isNotNull())
    # Only the word after, with what is ahead of the match; null for the other patterns.
    each = F.transform(
        known,
        lambda p: F.struct(
            p.alias("pattern"),
            F.when(p.startswith("_ "), F.coalesce(left, F.lit(""))).alias("ahead"),
        ),
    )
    return matches.select("*", F.inline(each)).drop("before", "after")


def _spread(edges: DataFrame, seeds: DataFrame, rounds: int) -> DataFrame:
    """(pattern, kind, score, seeds) after the rounds; edges are (pattern, instance, n)."""
    known = written(
        edges.join(seeds, "instance").groupBy("pattern", "seed_kind").agg(
            F.sum("n").alias("seed_n"), F.count(F.lit(1)).alias("seeds")
        ),
        "pii-seeds",
    ).withColumnRenamed("seed_kind", "kind")
    totals = edges.groupBy("pattern").agg(F.sum("n").alias("total"))
    # Patterns without a seed of a kind have score 0 for it and need no row.
    start = known.join(totals, "pattern")
    patterns = written(
        start.select("pattern", "kind", "seeds", (F.col("seed_n") / F.col("total")).alias("score")),
        "pii-patterns",
    )
    unseen = written(edges.join(seeds, "instance", "left_anti"), "pii-unseen")
    weights = unseen.groupBy("instance").agg(F.sum("n").alias("weight"))
    for _ in range(rounds):
        reached = unseen.join(patterns, "pattern").groupBy("instance", "kind").agg(
            F.sum(F.col("n") * F.col("score")).alias("sum")
        )
        instances = reached.join(weights, "instance").select(
            "instance", "kind", (F.col("sum") / F.col("weight")).alias("value")
        )
        gained = unseen.join(instances, "instance").groupBy("pattern", "kind").agg(
            F.sum(F.col("n") * F.col("value")).alias("gained")
        )
        scored = start.join(gained, ["pattern", "kind"], "left").select(
            "pattern",
            "kind",
            "seeds",
            (
                (F.col("seed_n") + F.coalesce("gained", F.lit(0.0))) / F.col("total")
            ).alias("score"),
        )
        patterns = written(scored, "pii-patterns")
    return patterns


def discovered(
    base: DataFrame,
    words: DataFrame,
    rounds: int = ROUNDS,
    least_seeds: int = LEAST_SEEDS,
    least_score: float = LEAST_SCORE,
) -> DataFrame:
    """(doc_id, version, kind, start, end): words in contexts that betray a kind.

    ``base`` and ``words`` are as ``located`` returns them.
    """
    taken = base.groupBy(*DOCUMENT).agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    b, t = words.alias("b"), taken.alias("t")
    same = F.col("b.doc_id").eqNullSafe(F.col("t.doc_id")) & (
        F.col("b.version") == F.col("t.version")
    )
    overlaps = F.exists(
        "spans", lambda s: (s["start"] < F.col("b.end")) & (F.col("b.start") < s["end"])
    )
    free = b.join(t, same, "left").filter(~F.coalesce(overlaps, F.lit(False))).select("b.*")
    fields = [*DOCUMENT, "start", "end", "instance", "seed_kind", "pattern", "ahead"]
    matches = base.withColumn("seed_kind", F.col("kind")).unionByName(
        free.withColumn("seed_kind", F.lit(None).cast("string"))
    )
    instance = F.xxhash64(F.lower("found"))
    found = written(
        _contexts(matches).withColumn("instance", instance).select(*fields), "pii-contexts"
    )
    edges = written(
        found.groupBy("pattern", "instance").agg(F.count(F.lit(1)).alias("n")), "pii-edges"
    )
    seeds = found.filter("seed_kind IS NOT NULL").select("instance", "seed_kind").distinct()
    patterns = _spread(edges, written(seeds, "pii-instances"), rounds)
    good = patterns.filter((F.col("score") >= least_score) & (F.col("seeds") >= least_seeds))
    after = found.filter("seed_kind IS NOT NULL AND ahead IS NOT NULL")
    varied = after.groupBy("pattern", F.col("seed_kind").alias("kind")).agg(
        F.countDistinct("ahead").alias("different")
    )
    sure = good.select("pattern", "kind").join(varied, ["pattern", "kind"], "left")
    unseen = found.filter("seed_kind IS NULL").drop("seed_kind")
    marked = unseen.join(sure, "pattern")
    alone = F.col("ahead").isNull() | (F.col("ahead") == "")
    decides = alone | F.coalesce(F.col("different") >= least_seeds, F.lit(False))
    kinds = marked.groupBy(*DOCUMENT, "start", "end").agg(
        F.max(decides).alias("decided"), F.min("kind").alias("kind"), F.max("kind").alias("other")
    )
    # What is sure of two kinds is of neither.
    return kinds.filter("decided AND kind = other").select(*DOCUMENT, "kind", "start", "end")


def spans(documents: DataFrame, **options) -> DataFrame:
    """(doc_id, version, kind, start, end, base) of all personal data found."""
    base = written(base_spans(documents), "pii-base")
    words = written(located(documents, WORDS), "pii-words")
    added = discovered(base, words, **options)
    fields = [*DOCUMENT, "kind", "start", "end"]
    return base.select(*fields, F.lit(True).alias("base")).unionByName(
        added.select(*fields, F.lit(False).alias("base"))
    )


def _of(order: int):
    return lambda x: x["order"] == order


def summary(documents: DataFrame, **options) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of each row.

    Counts and digest are those of the base spans; ``spans`` lists all, ``n_added`` the others.
    """
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    name = F.concat_ws(":", "kind", "start", "end")
    entry = F.struct(order.alias("order"), "start", "end", name.alias("name"), "base")
    found = spans(documents, **options).groupBy(*DOCUMENT).agg(
        F.array_sort(F.collect_list(entry)).alias("found")
    )
    rows = documents.select("doc_id", F.xxhash64("text").alias("version")).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (
        F.col("d.version") == F.col("f.version")
    )
    every = F.coalesce("f.found", F.array().cast(found.schema["found"].dataType))
    joined = rows.join(found.alias("f"), same, "left").select("d.doc_id", every.alias("every"))
    base = F.filter("every", lambda x: x["base"])

    def listed(entries: Column) -> Column:
        return F.array_join(F.transform(entries, lambda x: x["name"]), ",")

    counts = [
        F.size(F.filter(base, _of(i + 1))).cast("long").alias(f"n_{kind}")
        for i, kind in enumerate(KINDS)
    ]
    return joined.select(
        "doc_id",
        *counts,
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("every")).alias("spans"),
        (F.size("every") - F.size(base)).cast("long").alias("n_added"),
    )
