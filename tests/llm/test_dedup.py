"""Exact dedup, line dedup and the n-gram Jaccard join against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.llm import exact, jaccard, linededup, queries

from .fixtures import CLASHES, odd_rows, sentence, split_words, table


def exact_want(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    out = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        left = 1
        for i in ids:
            kept = i == keep and left > 0
            left -= kept
            out[i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()] += 1
    return out


def test_exact_duplicates(spark):
    rows = odd_rows()
    got = exact.duplicates(table(spark, rows)).collect()
    assert Counter(map(tuple, got)) == exact_want(rows)
    kept = exact.deduplicated(table(spark, rows))
    assert kept.columns == table(spark, rows).columns
    assert Counter(r["text"] or "" for r in kept.collect()) == Counter({r[1] or "" for r in rows})
    empty = table(spark, rows).limit(0)
    assert exact.duplicates(empty).count() == exact.deduplicated(empty).count() == 0


def test_colliding_hashes_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(exact, "fingerprint", lambda *parts, salt=0: F.lit(1).cast("long"))
    rows = odd_rows()
    assert Counter(map(tuple, exact.duplicates(table(spark, rows)).collect())) == exact_want(rows)


def test_chunks_follow_the_content(spark):
    rng = random.Random(1)
    text = ". ".join(sentence(rng, 12) for _ in range(200))
    df = spark.createDataFrame([(text,), ("z" * 10_000,), ("",)], "text string")
    a, b, c = (r[0] for r in df.select(exact.chunks(F.col("text"))).collect())
    assert "".join(a) == text and all(512 <= len(x) <= 4096 for x in a[:-1])
    assert "".join(b) == "z" * 10_000 and max(map(len, b)) == 4096 and c == []


def lines_want(rows):
    """doc_id -> (lines, removed, text), for distinct doc_ids."""
    windows, solid = [], {}
    for doc, text in rows:
        bare = [(i, x.strip(" \t\r")) for i, x in enumerate((text or "").split("\n"))]
        solid[doc] = [(i, x) for i, x in bare if x]
        for p in range(max(len(solid[doc]) - 2, min(1, len(solid[doc])))):
            windows.append((doc, p, tuple(x for _, x in solid[doc][p : p + 3])))
    first, gone = {}, defaultdict(set)
    for doc, p, w in sorted(windows):
        if first.setdefault(w, (doc, p)) != (doc, p):
            gone[doc] |= {i for i, _ in solid[doc][p : p + 3]}
    out = {}
    for doc, text in rows:
        every = (text or "").split("\n")
        kept = "\n".join(x for i, x in enumerate(every) if i not in gone[doc])
        out[doc] = (0, 0, None) if text is None else (len(every), len(gone[doc]), kept)
    return out


def test_line_windows(spark):
    rng = random.Random(5)
    pool = [sentence(rng, 3) for _ in range(6)] + ["", "  ", " a \r"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))) for i in range(60)]
    rows += [(100, None), (101, "")]
    got = linededup.without_repeats(table(spark, rows)).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == lines_want(rows)


def test_line_windows_odd_rows(spark):
    got = linededup.without_repeats(table(spark, odd_rows())).collect()
    assert len(got) == len(odd_rows())
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    assert by[5][0] == by[5][1] and by[5][0]["text"] == ""  # a whole later text
    assert by[1][0]["n_removed"] == 0 and by[11][0]["text"] == "" and by[2][0]["text"] is None
    assert by[12][0]["text"] == "a b\n\n c d "[:-1] + " \r" and by[12][0]["n_removed"] == 3
    assert linededup.without_repeats(table(spark, []).limit(0)).count() == 0


def shingles(text, words=4):
    w = split_words(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1)))


def components_want(rows, words=4, percent=85):
    sets = {i: shingles(t, words) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(seed, n=160):
    """Chains and clusters of edited texts of all sizes."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.7:
            w = split_words(rng.choice(rows)[1])
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                at = rng.randrange(len(w) + 1)
                w[at : at + rng.randint(0, 2)] = [sentence(rng, 1)] * rng.randint(0, 2)
            rows.append((i, " ".join(w)))
        else:
            rows.append((i, sentence(rng, rng.choice([1, 3, 6, 12, 30, 60, 150, 400]))))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components(spark, seed):
    rows = near_copies(seed)
    got = jaccard.near_duplicates(table(spark, rows), words=4, percent=85).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == components_want(rows)


def test_jaccard_hot_group(spark):
    """Very many near copies of one text, of which some are linked only through others."""
    rng = random.Random(9)
    base = split_words(sentence(rng, 60))
    rows = []
    for i in range(300):
        w = list(base)
        for at in rng.sample(range(60), rng.randint(0, 3)):
            w[at] = sentence(rng, 1)
        rows.append((i, " ".join(w)))
    got = jaccard.near_duplicates(table(spark, rows), words=4, percent=85).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == components_want(rows)


def test_jaccard_odd_rows(spark):
    docs = table(spark, odd_rows())
    got = jaccard.near_duplicates(docs).collect()
    assert len(got) == len(odd_rows())
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert {by[i]["component_id"] for i in (1, 5, 6)} == {1}
    assert by[2]["component_id"] == 2 and by[3]["n_shingles"] == 0 and by[9]["component_id"] == 8
    assert all(r["component_id"] is None for r in got if r["doc_id"] is None)
    stay = jaccard.representatives(docs)
    assert stay.columns == docs.columns and {r["key"] for r in stay.collect()} == {"key"}
    ids = {r["doc_id"] for r in stay.collect()}
    assert {1, 2, 3, 8, None} <= ids and not {5, 6, 9} & ids
    assert jaccard.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("percent", [80, 85])
def test_linked_sets_share_a_key(percent):
    rng = np.random.default_rng(percent)
    for n in [*range(1, 60), 150, 700]:
        for _ in range(20):
            a = rng.integers(0, 2**64, n, dtype=np.uint64)
            # As many changes as a link allows, so that few blocks agree.
            drop = int(rng.integers(0, n * (100 - percent) // percent + 1))
            b = np.concatenate([a[drop:], rng.integers(0, 2**64, drop // 2, dtype=np.uint64)])
            a, b = np.unique(a), np.unique(b)
            both = len(np.intersect1d(a, b))
            if 100 * both < percent * (len(a) + len(b) - both) or np.array_equal(a, b):
                continue
            sizes = np.array([len(a), len(b)])
            owner, key = jaccard.join_keys(np.concatenate([a, b]), sizes, percent)
            assert set(key[owner == 0].tolist()) & set(key[owner == 1].tolist()), (n, drop)


def sketch_of(x):
    sketch, ends = jaccard._sketches(x, np.array([len(x)]))
    assert ends.tolist() == [0, len(sketch)]
    return sketch


def test_sketch_distance_bounds_the_difference(spark):
    rng = np.random.default_rng(2)
    pairs = []
    for n in (5, 50, 1000, 2000, 9000):
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[n // 4 :], rng.integers(0, 2**64, n // 3, dtype=np.uint64)]))
        wide = [sketch_of(x)[None, :] for x in (a, b)]
        assert all(w.shape[1] * 64 >= len(x) for w, x in zip(wide, (a, b)))
        width = min(w.shape[1] for w in wide)
        sa, sb = (jaccard._folded(w, width) for w in wide)
        apart = int(np.bitwise_count(sa ^ sb).sum())
        assert apart <= len(np.setxor1d(a, b)) and apart % 2 == len(np.setxor1d(a, b)) % 2
        pairs.append((*(w[0].view(np.int64).tolist() for w in wide), apart))
    assert {len(p[0]) == len(p[1]) for p in pairs} == {True, False}
    df = spark.createDataFrame(pairs, "a array<long>, b array<long>, apart long")
    got = df.select("apart", jaccard.distance("a", "b"), jaccard.distance("b", "a")).collect()
    assert all(r[0] == r[1] == r[2] for r in got)


def test_sketches_of_unrelated_long_sets_stay_apart():
    rng = np.random.default_rng(4)
    for n in (500, 1024, 1025, 3000, 20_000, 200_000):
        a, b = (np.unique(rng.integers(0, 2**64, n, dtype=np.uint64)) for _ in range(2))
        sa, sb = (jaccard._folded(sketch_of(x)[None, :], 16 if n <= 1024 else 10**9) for x in (a, b))
        allowed = (len(a) + len(b)) * 20 // 180
        assert int(np.bitwise_count(sa ^ sb).sum()) > 1.5 * allowed


def test_task_portions_name_the_first_of_a_key():
    one = (np.array([5, 7, 5, 9], np.uint64), np.array([3, 3, 2, 4]))
    two = (np.array([5, 9, 9, 7], np.uint64), np.array([8, 4, 1, 3]))
    rows = [r for b in jaccard._led([one, two]) for r in b.to_pylist()]
    assert sorted((r["key"], r["doc_id"], r["lead"], r["many"]) for r in rows if r["lead"]) == [
        (5, 3, 2, True), (5, 8, 2, True), (9, 4, 1, True)
    ]
    assert sorted((r["key"], r["doc_id"], r["many"]) for r in rows if not r["lead"]) == [
        (5, 2, True), (7, 3, False), (9, 1, True)
    ]
    none = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    assert list(jaccard._led([none])) == []


@pytest.mark.parametrize("held", [1, 700, 1 << 20])
def test_jaccard_portions_give_the_same(spark, monkeypatch, held):
    monkeypatch.setattr(jaccard, "HELD", held)
    rows = near_copies(5, 120)
    docs = table(spark, rows).repartition(4)
    got = jaccard.near_duplicates(docs, words=4, percent=85).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == components_want(rows)


def test_hot_keys_meet_pre_aggregated(spark):
    """Of the documents with a hot key a task sends but one to the others."""
    rng = random.Random(10)
    base = sentence(rng, 90)
    rows = [(i, f"{base} {sentence(rng, 1 + i % 3)}") for i in range(3000)]
    docs = table(spark, rows).coalesce(2).select("doc_id", "text")
    jaccard.ship(spark)
    met = jaccard.keyed(docs, 5, 80).groupBy("key").agg(
        F.count("*").alias("n"), F.count_if(F.col("lead").isNull()).alias("leads")
    )
    hot = met.orderBy(F.desc("n")).first()
    assert hot["n"] > 1500 and hot["leads"] <= 2


def test_long_unrelated_texts_with_a_passage(spark):
    """Blocks hold few of many pairs back; none of unrelated sets is left to verify."""
    rng = random.Random(11)
    shared = sentence(rng, 700)
    rows = [(i, shared + " " + sentence(rng, 4000)) for i in range(70)]
    near = rows[5][1].split()
    near[2000] = "changed"
    rows.append((90, " ".join(near)))
    docs = table(spark, rows).select("doc_id", "text")
    jaccard.ship(spark)
    sets = jaccard.durable(jaccard.sets_of(docs, 5))
    met = sets.select(F.lit(1).alias("key"), "doc_id", F.lit(0).alias("head"))
    none = spark.createDataFrame([], "doc_id long, component long")
    got = jaccard.compared(met, none, sets, 80).collect()
    assert [tuple(r) for r in got] == [(5, 90)]


def shuffled(df) -> list[int]:
    """Runs the query; the rows that each of its shuffles wrote."""
    df.collect()
    counts, plans = [], [df._jdf.queryExecution().executedPlan()]
    while plans:
        plan = plans.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            plans.append(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            plans.append(plan.plan())
        elif kind == "ShuffleExchangeExec":
            counts.append(plan.metrics().apply("shuffleRecordsWritten").value())
        children = plan.children()
        plans += [children.apply(i) for i in range(children.size())]
    return counts


def test_few_sets_are_shuffled_to_verify_few_pairs(spark):
    rng = random.Random(12)
    rows = [(i, sentence(rng, 60)) for i in range(2000)]
    rows += [(2000 + i, rows[i][1] + " more") for i in range(20)]
    jaccard.ship(spark)
    sets = jaccard.durable(jaccard.sets_of(table(spark, rows).select("doc_id", "text"), 4))
    pairs = spark.createDataFrame([(i, 2000 + i) for i in range(20)] + [(5, 6)], "a long, b long")
    links = jaccard.verified(pairs, sets, 85)
    counts = shuffled(links)
    assert counts and max(counts) < 300
    assert {tuple(r) for r in links.collect()} == {(i, 2000 + i) for i in range(20)}


def test_keys_of_several_components_bring_all_documents(spark):
    """Keys of one component stay; those of several bring all of their documents, by any head."""
    n = 30_000
    met = spark.range(n).selectExpr("id AS key", "id AS doc_id", "id AS head")
    met = met.unionByName(spark.range(n).selectExpr("id AS key", "id + 100000 AS doc_id", "id AS head"))
    # Of key 7 document 7 is the first, 100007 leads 200007, which is the one apart.
    more = [(7, 200007, 100007), (8, 200007, 8)]
    met = jaccard.durable(met.unionByName(spark.createDataFrame(more, "key long, doc_id long, head long")))
    joined = jaccard.durable(spark.range(n).selectExpr("id + 100000 AS doc_id", "id AS component"))
    sketch = F.array_repeat(F.lit(1).cast("long"), 16)
    sets = met.select("doc_id").distinct().select(
        "doc_id", F.array_repeat(F.lit(1), 90).alias("shingles"), sketch.alias("sketch")
    )
    got = jaccard.compared(met, joined, jaccard.durable(sets), 80)
    assert {tuple(r) for r in got.collect()} == {(7, 200007), (100007, 200007), (8, 200007), (100008, 200007)}


@pytest.mark.parametrize("filtered", [0, 1 << 23])
def test_jaccard_with_a_filter_or_a_join(spark, monkeypatch, filtered):
    monkeypatch.setattr(jaccard, "FILTERED", filtered)
    rows = near_copies(6, 120)
    got = jaccard.near_duplicates(table(spark, rows), words=4, percent=85).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == components_want(rows)


def test_filters_grow_with_their_content(spark):
    rows = spark.range(200_000).withColumnRenamed("id", "doc_id")
    for wanted in (0, 1, 40_000):
        some = rows.filter(F.col("doc_id") < wanted)
        got = jaccard.possible(rows, some).groupBy(F.col("doc_id") < wanted, "possible").count()
        counts = {(r[0], r[1]): r[2] for r in got.collect()}
        assert counts.get((True, False), 0) == 0 and counts.get((True, True), 0) == wanted
        assert counts.get((False, True), 0) <= 0.065 * 200_000


def test_components_of_chains(spark):
    pairs = [(i, i + 1) for i in range(1, 60)] + [(100, 90), (90, 95), (200, 201), (200, 201)]
    got = jaccard.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    want = {i: 1 for i in range(2, 61)} | {100: 90, 95: 90, 201: 200}
    assert {r[0]: r[1] for r in got} == want


@pytest.mark.parametrize("name", ["op5_line_dedup", "op6_exact_dedup"])
def test_queries_match_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
        want = con.execute(queries.oracle_sql()[name])
        columns = [c[0] for c in want.description]
        got = queries.queries()[name](spark, folder).select(*columns).collect()
        assert Counter(map(tuple, got)) == Counter(want.fetchall())


def test_jaccard_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = queries.queries()["op2_ngram_jaccard"](spark, folder).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == components_want([tuple(r) for r in docs])


def test_clashing_columns_are_there():
    assert {"document", "key", "rows"} <= set(CLASHES)


def test_rows_that_differ_in_source_only(spark):
    rows = [(1, "same text", "en", f"s{i}") for i in range(20)] + [(0, "same text", "en", "z")]
    kept = {
        tuple(map(tuple, exact.deduplicated(table(spark, rows).repartition(n)).select("doc_id", "source").collect()))
        for n in (1, 2, 5, 7)
    }
    assert len(kept) == 1 and len(next(iter(kept))) == 1 and next(iter(kept))[0][0] == 1


def split_joins(spark, run, factor="1.5"):
    """The plan of the query, run so that a partition with a third of the rows counts as skewed."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": factor,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = run()
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_groups_are_split(spark):
    rng = random.Random(12)
    rows = [(i, "one\ntwo\nthree" if i % 3 == 0 else sentence(rng, 20), "en") for i in range(6000)]
    docs = table(spark, rows).repartition(8)
    # Rows of copies are alike and compress well, so they weigh little in so small a table.
    assert "skew=true" in split_joins(spark, lambda: exact.decisions(docs), "0.1")
    assert "skew=true" in split_joins(spark, lambda: linededup.repeated_lines(docs))
    assert Counter(map(tuple, exact.duplicates(docs).collect())) == exact_want(rows)
