"""Merkle manifests and spelling variants against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cohortloom.llm import merkle, spelling

from .fixtures import odd_rows, sentence, table


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def spelled(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(nodes: list[str], fanout: int) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([digest(*last[i : i + fanout]) for i in range(0, len(last), fanout)])
    return out


def siblings(tree: list[list[str]], place: int, fanout: int) -> list[tuple[str, str]]:
    out = []
    for nodes in tree[:-1]:
        begin = place - place % fanout
        out.append(("".join(nodes[begin:place]), "".join(nodes[place + 1 : begin + fanout])))
        place //= fanout
    return out


def manifest_want(rows: list[tuple], fanout: int) -> Counter:
    """Rows (doc_id, source, lang, n_chars, text) to (doc_id, leaf, claim, subroot, root, path)."""
    trees = defaultdict(list)
    for row in rows:
        leaf = digest(*map(spelled, row))
        more = (*row[:3], None if row[3] is None else row[3] + 1, row[4])
        trees[row[2]].append((row[0], leaf, None if row[3] is None else digest(*map(spelled, more))))
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    built = {}
    for name in names:
        trees[name].sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
        built[name] = levels([t[1] for t in trees[name]], fanout)
    top = levels([built[n][-1][0] for n in names], fanout)
    out = Counter()
    for i, name in enumerate(names):
        for place, (doc_id, leaf, claim) in enumerate(trees[name]):
            path = siblings(built[name], place, fanout) + siblings(top, i, fanout)
            out[doc_id, leaf, claim, built[name][-1][0], top[-1][0], tuple(path)] += 1
    return out


def manifest_got(df, fanout):
    got = merkle.manifest(df, fanout=fanout, claims={"n_chars": F.col("n_chars") + 1})
    return Counter(
        (r["doc_id"], r["leaf"], r["claim"], r["subroot"], r["root"], tuple(map(tuple, r["path"])))
        for r in got.collect()
    )


def fields(df) -> list[tuple]:
    return [tuple(r) for r in df.select(*merkle.FIELDS).collect()]


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_manifest(spark, fanout):
    df = table(spark, odd_rows())
    assert manifest_got(df, fanout) == manifest_want(fields(df), fanout)


def test_manifest_of_a_hot_tree_over_many_tasks(spark):
    rows = [(i % 700, f"text {i}", "en" if i % 3 else ("de", None, "é")[i % 9 // 3]) for i in range(2000)]
    df = table(spark, rows).repartition(7).withColumn("n_chars", F.col("n_chars").cast("long"))
    assert manifest_got(df, 2) == manifest_want(fields(df), 2)


@pytest.mark.parametrize("rows", [1, 2, 3, 4, 5, 16, 17, 33])
def test_small_trees(spark, rows):
    df = table(spark, [(i, str(i), "en") for i in range(rows)])
    assert manifest_got(df, 2) == manifest_want(fields(df), 2)


def test_empty_table_and_bad_fanout(spark):
    df = table(spark, odd_rows())
    assert merkle.manifest(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        merkle.manifest(df, fanout=1)


def test_proofs_and_tampering(spark):
    df = table(spark, odd_rows())
    got = (
        merkle.manifest(df, claims={"text": F.concat("text", F.lit("!"))})
        .withColumn("good", merkle.folded(F.col("leaf")) == F.col("root"))
        .withColumn("bad", merkle.folded(F.col("claim")) == F.col("root"))
        .withColumn("proof", merkle.proof())
        .collect()
    )
    assert all(r["good"] for r in got) and not any(r["bad"] for r in got if r["claim"])
    assert sum(r["claim"] is None for r in got) == sum(r[1] is None for r in odd_rows())
    assert all(r["proof"] == digest(*(a + b for a, b in r["path"])) for r in got)


def words_want(texts: list[tuple]) -> Counter:
    out = Counter()
    upper = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for doc_id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(upper)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return out


def variants_want(n: dict[str, int]) -> set[tuple]:
    near = defaultdict(set)
    shorter = defaultdict(set)
    for word in n:
        for i in range(len(word)):
            less = word[:i] + word[i + 1 :]
            shorter[i, less].add(word)
            if less in n:
                near[word].add(less)
                near[less].add(word)
    for group in shorter.values():
        for word in group:
            near[word] |= group - {word}
    form = {}
    for word, around in near.items():
        best = min(around, key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 5 * n[word]:
            form[word] = best
    out = set()
    for word in n:
        root = word
        while root in form:
            root = form[root]
        out.add((word, n[word], len(near[word]), form.get(word), n.get(form.get(word)), root))
    return out


def variants_got(spark, n: dict[str, int]) -> set[tuple]:
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    got = spelling.variants(df).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert len(got) == len({r["word"] for r in got})
    return set(map(tuple, got))


def random_words(seed: int, count: int) -> dict[str, int]:
    rng = random.Random(seed)
    out = {}
    for _ in range(count):
        word = "".join(rng.choice("abÀé😀") for _ in range(rng.randint(1, 7)))
        out[word] = 5 ** rng.randint(0, 6)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_variants_of_random_words(spark, seed):
    n = random_words(seed, 600)
    assert variants_got(spark, n) == variants_want(n)


def test_crowded_groups_are_cut_by_letters(spark):
    rng = random.Random(5)
    # A third of the words share all but the last letters.
    n = {"hotstart" + "".join(rng.choice("abcd") for _ in range(4)): rng.randint(1, 900) for _ in range(200)}
    n |= random_words(9, 400)
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    pairs = {tuple(r) for r in spelling.near_words(df).collect()}
    assert {tuple(r) for r in spelling.near_words(df, crowd=3).collect()} == pairs
    largest = spelling.grouped(df, crowd=3).groupBy("key").count().agg(F.max("count")).first()[0]
    assert largest <= 10
    assert variants_got(spark, n) == variants_want(n)


def test_very_long_words(spark):
    rng = random.Random(2)
    long = "".join(rng.choice("abc") for _ in range(5000))
    n = {long: 100, long[:-1]: 9, long[:2500] + "x" + long[2501:]: 3, "y" + long: 500, "abcdef": 7}
    assert variants_got(spark, n) == variants_want(n)


def test_many_words_in_one_index():
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(3, 6))) for _ in range(700)})
    left, right = spelling.LetterIndex(words).pairs()
    got = Counter((words[a], words[b]) for a, b in zip(left, right))
    want = {(w, v[3]) for v in variants_want({w: 1 for w in words}) for w in [v[0]] if v[3]}
    near = {w: c for w, _, c, *_ in variants_want({w: 1 for w in words})}
    assert set(got.values()) == {1} and not want
    assert Counter(a for a, _ in got) == Counter({w: c for w, c in near.items() if c})


def test_words_of_documents(spark):
    rng = random.Random(4)
    rows = odd_rows() + [(200 + i, sentence(rng, 300).upper() + " Éclair×÷ café-Bär", "en") for i in range(40)]
    n = words_want([r[:2] for r in rows])
    got = spelling.document_words(table(spark, rows)).groupBy("word").count().collect()
    # Runs too short to give a word are not listed.
    assert {w: c for w, c in map(tuple, got) if len(w) >= 6} == {w: c for w, c in n.items() if len(w) >= 6}
    words = spelling.vocabulary(spelling.document_words(table(spark, rows)))
    assert dict(map(tuple, words.collect())) == {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    empty = spelling.vocabulary(spelling.document_words(table(spark, rows).limit(0)))
    assert spelling.variants(empty).count() == 0
