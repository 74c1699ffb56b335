"""Secrets in texts: fixed patterns, and strings that look random to character Markov models."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, whole_text

#: Kind, pattern, least length. A match that is too short still uses up its text.
ASSIGN = r"""(?i:(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)[A-Za-z0-9+/_.=-]+"""
ASSIGN_HEAD = r"""(?i:^(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_ASSIGNED = 6
#: What the models judge: the parts of runs of the alphabet that hold a letter, at least so long.
LEAST_RANDOM = 12
CANDIDATE = r"[A-Za-z0-9+/_=-]{%d,}" % LEAST_RANDOM
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: What ordinary words, identifiers, paths and slugs are looked for in, and where parts of them meet
#: without a separator. Strings with more such borders than one and than every fifth character are
#: not built of words, nor are those with longer words than any dictionary has many of.
RUN = r"[A-Za-z0-9+/_=-]{2,}"
BORDER = r"(?<=[a-z])(?=[A-Z])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"
APART = 5
LONG_WORD = "[a-z]{18}|[A-Z]{18}"
#: The part of each letter's pairs that is spread out, whatever their number. Random strings of one
#: kind, such as hexadecimal ones, must not make other kinds unlikely: theirs is spread evenly.
#: Ordinary ones' goes by `classes`, in which again a part is spread evenly: of the step from class
#: to class half, of letters without regard to case little.
EVEN = {"random": 0.5, "ordinary": 0.5}
EVEN_STEP, EVEN_LETTER = 0.5, 0.02
#: Log-likelihood ratio per character from which a string counts as random.
THRESHOLD = 0.5
#: The ratio that a part must reach in all, since the best of very many parts is looked at.
EVIDENCE = 9.0
#: A part ends where its ratio has fallen so far below its best; ends this near to those of the run
#: are moved there.
FALL = 10.0
EDGE = 3
#: Parts of one run that are gathered in one array.
BLOCK = 256
SPANS = "array<struct<start:int,rank:int,kind:string,stop:int,value:string>>"


def let(value: Column, body) -> Column:
    """body(value), with the value computed once."""
    return F.transform(F.array(value), body)[0]


def running(numbers: Column) -> Column:
    """Running sums of an array of numbers, by steps that double: n log n in all."""

    def steps(n: Column) -> Column:
        last = F.floor(F.log2(n - 0.5)).cast("int")
        return F.when(n < 2, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), last))

    def step(sums: Column, k: Column) -> Column:
        back = F.call_function("shiftleft", F.lit(1), k)
        return F.transform(sums, lambda x, i: x + F.coalesce(F.get(sums, i - back), F.lit(0)))

    return let(numbers, lambda all_: F.aggregate(steps(F.size(all_)), all_, step))


def spans(text: Column, pattern: str, kind: str, rank: int) -> Column:
    """All leftmost non-overlapping matches as structs of code points, end exclusive, with text."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))

    def placed(values: Column) -> Column:
        taken = F.zip_with(gaps, values, lambda g, v: F.length(g) + F.length(v))
        return F.zip_with(
            values,
            running(taken),
            lambda v, stop: F.struct(
                (stop - F.length(v)).alias("start"), F.lit(rank).alias("rank"),
                F.lit(kind).alias("kind"), stop.alias("stop"), v.alias("value"),
            ),
        )

    return F.when(text.rlike(pattern), let(found, placed)).otherwise(F.array()).cast(SPANS)


def found(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its base spans and its runs of the alphabet."""
    body = F.col("body")
    assigned = F.filter(
        spans(body, ASSIGN, "assign", 0),
        lambda s: F.length(F.regexp_replace(s["value"], ASSIGN_HEAD, "")) >= LEAST_ASSIGNED,
    )
    return durable(
        docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("body")).select(
            "doc_id",
            assigned.alias("assign"),
            spans(body, ACCESS, "access", 1).alias("access"),
            spans(body, HEX, "hex", 2).alias("hex"),
            spans(body, CANDIDATE, "random", 3).alias("runs"),
        )
    )


def neighbours(items: Column, n: Column, of) -> Column:
    """`of` each of the first n items, two or more, and the one after it."""
    return F.zip_with(F.slice(items, F.lit(1), n - 1), F.slice(items, F.lit(2), n - 1), of)


def ordinary(docs: DataFrame, text: str = "text") -> DataFrame:
    """(v): the ordinary words and identifiers of all rows, none of what base patterns match."""
    bare = whole_text(text)
    for pattern in (ASSIGN, ACCESS, HEX):
        bare = F.regexp_replace(bare, pattern, " ")
    return docs.select(F.explode(F.regexp_extract_all(bare, F.lit(RUN), F.lit(0))).alias("v"))


def of_words(v: Column) -> Column:
    def few(part: Column) -> Column:
        borders = F.regexp_count(part, F.lit(BORDER))
        return (borders <= 1) | (borders * APART <= F.length(part))

    return F.forall(F.split(v, "[+/_=-]"), few) & ~v.rlike(LONG_WORD)


def kind_of(c: str) -> str:
    return "lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit() else "mark"


def classes(counts: dict[str, int]) -> dict[str, float]:
    """P(next | this) for all pairs of the alphabet by their classes, from counts of pairs.

    The class of the next character follows from that of this one. Within a word a letter follows
    from the letter before, in whatever case; else all of a class are alike.
    """
    steps: dict = Counter()
    letters: dict = Counter()
    inner = {("lower", "lower"), ("upper", "upper"), ("upper", "lower")}
    for pair, n in counts.items():
        step = tuple(map(kind_of, pair))
        steps[step] += n
        steps[step[0]] += n
        if step in inner:
            letters[pair.lower()] += n
            letters[pair[0].lower()] += n
    sizes = Counter(map(kind_of, ALPHABET))
    out = {}
    for a in ALPHABET:
        for b in ALPHABET:
            one, two = kind_of(a), kind_of(b)
            p = EVEN_STEP / len(sizes) + (1 - EVEN_STEP) * (
                steps[one, two] / steps[one] if steps[one] else 1 / len(sizes)
            )
            x, total = (a + b).lower(), letters[a.lower()]
            if (one, two) in inner and total:
                q = EVEN_LETTER / 26 + (1 - EVEN_LETTER) * letters[x] / total
            else:
                q = 1 / sizes[two]
            out[a + b] = p * q
    return out


def ratios(rows: DataFrame, words: DataFrame) -> list[float]:
    """Log of P(next | this, random) / P(next | this, ordinary) for all pairs of the alphabet.

    Random strings are what the base patterns matched in `rows`; ordinary ones are those of `words`
    that are built of words. All are counted. Only pair counts come to the driver, at most two for each pair of the alphabet.
    """
    secret = F.transform(
        F.concat("assign", "access", "hex"),
        lambda s: F.regexp_replace(F.regexp_replace(s["value"], ASSIGN_HEAD, ""), "^AKIA", ""),
    )

    def pairs(strings: DataFrame, label: str) -> DataFrame:
        """Equal strings are counted first, so that each is cut into pairs once."""
        return (
            strings.filter(F.length("v") > 1)
            .groupBy("v")
            .count()
            .select(
                F.explode(neighbours(F.split("v", ""), F.length("v"), lambda a, b: F.concat(a, b))).alias("pair"),
                F.lit(label).alias("label"),
                "count",
            )
        )

    counts = {
        (r["label"], r["pair"]): r["n"]
        for r in pairs(rows.select(F.explode(secret).alias("v")), "random")
        .unionByName(pairs(words.filter(of_words(F.col("v"))), "ordinary"))
        .filter(F.col("pair").rlike(r"^[A-Za-z0-9+/_=-]{2}$"))
        .groupBy("label", "pair")
        .agg(F.sum("count").alias("n"))
        .collect()
    }

    def logs(label: str) -> list[float]:
        even = EVEN[label]
        own = {pair: n for (x, pair), n in counts.items() if x == label}
        spread = (
            classes(own) if label == "ordinary"
            else {a + b: 1 / len(ALPHABET) for a in ALPHABET for b in ALPHABET}
        )
        out = []
        for a in ALPHABET:
            total = sum(own.get(a + b, 0) for b in ALPHABET)
            for b in ALPHABET:
                p = spread[a + b]
                out.append(math.log((1 - even) * own.get(a + b, 0) / total + even * p if total else p))
        return out

    return [a - b for a, b in zip(logs("random"), logs("ordinary"), strict=True)]


def uncovered(runs: Column, bases: Column) -> Column:
    """The parts of runs (apart, ascending) outside all base spans, as spans.

    All begins and ends are sorted together; running sums tell between each two of them whether, and
    in which run, the text there is, and in how many base spans.
    """

    def ends(spans_: Column, run: int) -> Column:
        def end(at: Column, step: int) -> Column:
            # A part between ends is in a run and no base: 1; the number of the run is beside it.
            inside = step if run else -2 * step
            return F.struct(
                at.alias("at"), F.lit(inside).alias("inside"),
                F.lit(run if step > 0 else 0).alias("run"),
            )

        return F.flatten(F.transform(spans_, lambda s: F.array(end(s["start"], 1), end(s["stop"], -1))))

    def parts(all_: Column, inside: Column, number: Column) -> Column:
        cut = F.transform(
            F.sequence(F.lit(0), F.size(all_) - 2),
            lambda i: F.struct(
                F.get(all_, i)["at"].alias("start"), F.get(all_, i + 1)["at"].alias("stop"),
                F.get(inside, i).alias("inside"), F.get(runs, F.get(number, i) - 1).alias("of"),
            ),
        )
        long = F.filter(cut, lambda p: (p["inside"] == 1) & (p["stop"] - p["start"] >= LEAST_RANDOM))
        return F.transform(
            long,
            lambda p: F.struct(
                p["start"].alias("start"), p["of"]["rank"].alias("rank"), p["of"]["kind"].alias("kind"),
                p["stop"].alias("stop"),
                F.substring(
                    p["of"]["value"], p["start"] - p["of"]["start"] + 1, p["stop"] - p["start"]
                ).alias("value"),
            ),
        )

    apart = let(
        F.array_sort(F.concat(ends(runs, 1), ends(bases, 0))),
        lambda all_: let(
            F.struct(
                running(F.transform(all_, lambda e: e["inside"])).alias("inside"),
                running(F.transform(all_, lambda e: e["run"])).alias("number"),
            ),
            lambda sums: parts(all_, sums["inside"], sums["number"]),
        ),
    )
    return F.when((F.size(bases) > 0) & (F.size(runs) > 0), apart).otherwise(runs).cast(SPANS)


def randomness(value: Column, table: list[float]) -> Column:
    """The log-likelihood ratio of each pair of neighbours."""
    n = len(ALPHABET)
    known = F.split(F.lit(",".join(f"{x:.6f}" for x in table)), ",").cast("array<double>")
    places = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    return neighbours(places, F.length(value), lambda a, b: F.get(known, a * n + b))


def random_parts(run: Column, table: list[float], threshold: float) -> Column:
    """The spans of a run whose summed ratio is furthest above the threshold, one after the other.

    A sum starts anew where it is used up or has fallen by FALL. Parts found are gathered in blocks,
    so that adding one does not copy all.
    """
    none = F.array().cast("array<struct<start:int,stop:int>>")
    zero = F.lit(0.0)

    def good(acc: Column) -> Column:
        size = acc["stop"] - acc["start"]
        return (size >= LEAST_RANDOM - 2 * EDGE) & (acc["top"] + size * threshold >= EVIDENCE)

    def closed(acc: Column) -> Column:
        own = F.array(F.struct(acc["start"].alias("start"), acc["stop"].alias("stop")))
        return (
            F.when(~good(acc), acc["parts"])
            .when(F.size(acc["parts"]) >= BLOCK, own)
            .otherwise(F.concat(acc["parts"], own))
        )

    def blocks(acc: Column) -> Column:
        full = good(acc) & (F.size(acc["parts"]) >= BLOCK)
        return F.when(full, F.concat(acc["blocks"], F.array(acc["parts"]))).otherwise(acc["blocks"])

    def step(acc: Column, x: Column) -> Column:
        at, total = acc["at"] + 1, acc["total"] + x - threshold
        over = (total <= 0) | (total < acc["top"] - FALL)
        more = total > acc["top"]
        return F.struct(
            at.alias("at"),
            F.when(over, zero).otherwise(total).alias("total"),
            F.when(over, zero).when(more, total).otherwise(acc["top"]).alias("top"),
            F.when(over, at).otherwise(acc["start"]).alias("start"),
            F.when(over, at).when(more, at + 1).otherwise(acc["stop"]).alias("stop"),
            F.when(over, closed(acc)).otherwise(acc["parts"]).alias("parts"),
            F.when(over, blocks(acc)).otherwise(acc["blocks"]).alias("blocks"),
        )

    start = F.struct(
        F.lit(0).alias("at"), zero.alias("total"), zero.alias("top"), F.lit(0).alias("start"),
        F.lit(0).alias("stop"), none.alias("parts"),
        F.array().cast("array<array<struct<start:int,stop:int>>>").alias("blocks"),
    )
    parts = F.aggregate(
        randomness(run["value"], table), start, step,
        lambda acc: F.flatten(F.concat(blocks(acc), F.array(closed(acc)))),
    )

    def span(p: Column) -> Column:
        n = F.length(run["value"])
        first = F.when(p["start"] <= EDGE, 0).otherwise(p["start"])
        last = F.when(p["stop"] >= n - EDGE, n).otherwise(p["stop"])
        return F.struct(
            (run["start"] + first).alias("start"), run["rank"].alias("rank"),
            run["kind"].alias("kind"), (run["start"] + last).alias("stop"),
            F.substring(run["value"], first + 1, last - first).alias("value"),
        )

    # Digits alone are as random in ordinary numbers.
    return F.filter(
        F.transform(parts, span),
        lambda s: (F.length(s["value"]) >= LEAST_RANDOM) & s["value"].rlike("[A-Za-z]"),
    )


def secret_spans(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """(doc_id, assign, access, hex, random): arrays of spans for each row.

    A span has start and stop in code points, stop exclusive, its kind and its text. The first
    three kinds are fixed patterns. `random` are the parts of runs of the alphabet, apart from
    those, that look most random: their log-likelihood ratio, random against ordinary, reaches the
    threshold per character and EVIDENCE in all. A missing text counts as empty; rows that repeat fare alike; the empty table gives none. Without any secret the random
    model is even over the alphabet.
    """
    rows = found(docs, doc_id, text)
    table = ratios(rows, ordinary(docs, text))

    runs = uncovered(F.col("runs"), F.concat("assign", "access", "hex"))
    parts = F.flatten(F.transform(runs, lambda r: random_parts(r, table, threshold)))
    return rows.withColumn("random", parts).drop("runs")
