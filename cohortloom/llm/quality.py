"""Quality filtering by weak supervision: rules that vote or abstain, weighed by EM."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, WORD, durable, fingerprint, whole_text

LEAST_WORDS = 50
#: Of a packed (hash, place) number; the other bits are the hash's.
PLACE_BITS = 26
#: (rule, its measure, bad beyond, good within); between the two it abstains.
RULES = (
    ("symbols", "n_symbols / n_words", 0.10, 0.02),
    ("marks", "n_marks / n_words", 0.10, 0.02),
    ("plain_words", "1 - n_plain / n_words", 0.40, 0.20),
    ("repeats", "n_repeat_words / n_words", 0.40, 0.25),
    ("dup_lines", "n_dup_lines / n_lines", 0.50, 0.25),
    ("capitals", "n_capitals / word_chars", 0.40, 0.15),
    ("exclaims", "n_exclaims / n_words", 0.30, 0.05),
    ("variety", "1 - n_distinct / n_words", 0.85, 0.70),
)
STEPS = 50
#: Before any vote: the share of good documents, and how often a rule is right.
GOOD_SHARE, ACCURACY = 0.8, 0.8
#: Added to each expected count, so that no rule becomes certain.
SMOOTHING = 1.0


def repeated_words(words: Column) -> Column:
    """How many words stand in three-word windows that occur twice or more in the text.

    Window hashes are packed with their places, so that sorting plain numbers brings equal ones
    together; the few that meet there are then compared by the full hash.
    """
    low = F.lit((1 << PLACE_BITS) - 1)
    high = F.lit(~((1 << PLACE_BITS) - 1))

    def at(p: Column) -> Column:
        return fingerprint(words[p], words[p + 1], words[p + 2])

    packed = F.sort_array(
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda p: at(p).bitwiseAND(high).bitwiseOR(p.cast("long")),
        )
    )

    def same(a: Column, b: Column) -> Column:
        return F.coalesce(a.bitwiseXOR(b).bitwiseAND(high) == 0, F.lit(False))

    def meeting(a: Column) -> Column:
        return F.transform(
            F.filter(
                a,
                lambda x, i: same(x, F.get(a, i - 1)) | same(x, F.get(a, i + 1)),
            ),
            lambda x: x.bitwiseAND(low).cast("int"),
        )

    def equal(a: Column) -> Column:
        return F.filter(
            a,
            lambda x, i: F.coalesce(x["h"] == F.get(a, i - 1)["h"], F.lit(False))
            | F.coalesce(x["h"] == F.get(a, i + 1)["h"], F.lit(False)),
        )

    def covered(a: Column) -> Column:
        return F.size(
            F.array_distinct(
                F.flatten(F.transform(a, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2)))
            )
        )

    def let(value: Column, body) -> Column:
        """body(value), with the value computed once."""
        return F.transform(F.array(value), body)[0]

    def full(places: Column) -> Column:
        return let(
            F.array_sort(F.transform(places, lambda p: F.struct(at(p).alias("h"), p.alias("p")))),
            lambda e: covered(equal(e)),
        )

    # Places that do not fit beside a hash are compared by the full one at once.
    return F.when(
        F.size(words) > (1 << PLACE_BITS), full(F.sequence(F.lit(0), F.size(words) - 3))
    ).when(
        F.size(words) > 3,
        let(
            packed,
            lambda a: let(
                meeting(a),
                lambda m: F.when(F.size(m) == 0, 0).otherwise(full(m)),
            ),
        ),
    ).otherwise(0)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents as column `document`, with what the rules look at.

    A missing text counts as empty. Words are what white space (blank, tab to return) separates.
    """
    body = F.col("body")
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(rf"[^{SPACE}]"))

    def chars(characters: str) -> Column:
        return F.size(F.regexp_extract_all(body, F.lit(characters), F.lit(0)))

    measures = F.struct(
        F.size("words").cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias(
            "word_chars"
        ),
        chars("[#*$%&|<>]").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        chars(r"\p{Lu}").cast("long").alias("n_capitals"),
        chars("!").cast("long").alias("n_exclaims"),
        chars(r"[^\p{L}\p{N}\s]{3,}|(?<=\s)[^\p{L}\p{N}\s](?=\s)").cast("long").alias("n_marks"),
        F.size(F.filter("words", lambda w: w.rlike(r"^\p{L}+[.,;:?!]?$")))
        .cast("long")
        .alias("n_plain"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
    )
    # The optimiser writes an expression out wherever it is used, but not through an explode.
    return (
        docs.select(F.struct("*").alias("document"), whole_text(text).alias("body"))
        .select(
            "document",
            "body",
            F.explode(
                F.array(
                    F.struct(
                        F.regexp_extract_all(body, F.lit(WORD), F.lit(0)).alias("words"),
                        lines.alias("lines"),
                    )
                )
            ).alias("split"),
        )
        .select("document", "body", "split.*")
        .select("document", F.explode(F.array(measures)).alias("measures"))
        .select("document", "measures.*")
    )


def base_failed() -> Column:
    return F.expr(f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words")


def votes(rules=RULES) -> Column:
    """One digit per rule: 2 good, 0 bad, 1 abstains, as it does where its measure is undefined."""
    return F.concat(
        *(
            F.expr(
                f"CASE WHEN n_words = 0 OR n_lines = 0 THEN '1' WHEN {measure} > {bad} THEN '0' "
                f"WHEN {measure} <= {good} THEN '2' ELSE '1' END"
            )
            for _, measure, bad, good in rules
        )
    )


def fit(counts: dict[str, int], n_rules: int, steps: int = STEPS) -> tuple[float, list[dict]]:
    """EM over vote patterns: the share of good documents, and of each rule P(vote | class, it votes).

    `counts` holds how often each pattern occurs: at most 3 ** n_rules numbers, however many the
    documents. Rules are taken as independent given the class. Starts from rules that are mostly
    right, which also fixes which class is the good one.
    """
    share = GOOD_SHARE
    start = {1: {"2": ACCURACY, "0": 1 - ACCURACY}, 0: {"2": 1 - ACCURACY, "0": ACCURACY}}
    rates = [{c: dict(start[c]) for c in (0, 1)} for _ in range(n_rules)]
    for _ in range(steps if counts else 0):
        sums = [{c: dict.fromkeys("02", SMOOTHING) for c in (0, 1)} for _ in range(n_rules)]
        good = total = 0.0
        for pattern, n in sorted(counts.items()):
            p = posterior(pattern, share, rates)
            good, total = good + n * p, total + n
            for rule, vote in enumerate(pattern):
                if vote == "1":
                    continue
                sums[rule][1][vote] += n * p
                sums[rule][0][vote] += n * (1 - p)
        share = (good + GOOD_SHARE) / (total + 1)
        rates = [
            {c: {v: x / sum(s[c].values()) for v, x in s[c].items()} for c in (0, 1)} for s in sums
        ]
    return share, rates


def posterior(pattern: str, share: float, rates: list[dict]) -> float:
    odds = math.log(share / (1 - share))
    for vote, rate in zip(pattern, rates, strict=True):
        if vote == "1":
            continue
        odds += math.log(rate[1][vote] / rate[0][vote])
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))


def probability(share: float, rates: list[dict], rules=RULES) -> Column:
    """`posterior` of the votes, from the measures."""
    odds = F.lit(math.log(share / (1 - share)))
    for (_, measure, bad, good), rate in zip(rules, rates, strict=True):
        for_good, for_bad = (math.log(rate[1][v] / rate[0][v]) for v in "20")
        odds = odds + F.expr(
            f"CASE WHEN n_words = 0 OR n_lines = 0 THEN 0D WHEN {measure} > {bad} THEN {for_bad}D "
            f"WHEN {measure} <= {good} THEN {for_good}D ELSE 0D END"
        )
    return 1 / (1 + F.exp(-odds))


def judged(features: DataFrame, rules=RULES, least: float = 0.5) -> DataFrame:
    """Adds votes, base_failed, quality (posterior) and kept to the rows of `measured`.

    Rule accuracies are estimated over all rows that pass the base; only the counts of vote
    patterns, at most 3 ** rules, come to the driver. kept is false where the base fails, else
    whether the posterior probability of a good document reaches `least`.
    """
    voted = features.withColumns({"votes": votes(rules), "base_failed": base_failed()})
    counts = voted.filter("NOT base_failed").groupBy("votes").count().collect()
    share, rates = fit({r["votes"]: r["count"] for r in counts}, len(rules))
    return voted.withColumn("quality", probability(share, rates, rules)).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= least)
    )


def assessed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, measures, votes, base_failed, quality and kept.

    Empty and missing texts have no words and fail the base. Rows that repeat are judged alike. The
    empty table gives none.
    """
    features = measured(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    return judged(durable(features.select("document.doc_id", *features.columns[1:])))


def good_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are kept, with their own columns; see `judged`.

    Texts are measured twice, not moved: a copy of them beside their measures would stay on disk as
    long as what follows reads it. Empty and missing texts fail the base, repeated rows fare alike,
    the empty table gives none.
    """
    features = measured(docs, text)
    narrow = durable(
        features.withColumns({"votes": votes(), "base_failed": base_failed()})
        .filter("NOT base_failed")
        .groupBy("votes")
        .count()
    )
    share, rates = fit({r["votes"]: r["count"] for r in narrow.collect()}, len(RULES))
    return (
        features.filter(~base_failed() & (probability(share, rates) >= 0.5))
        .select("document.*")
    )
