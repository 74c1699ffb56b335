"""Removal of repeated passages against plain Python."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.llm import anchors, repeats

from .fixtures import odd_rows, sentence, table


def want(rows: list[tuple], stretch: int, first_stays: bool) -> Counter:
    # Rows that share doc_id and text are one text to `first_stays`, but copies to each other.
    order = sorted({(r[0], r[1] or "") for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    many = Counter((r[0], r[1] or "") for r in rows)
    seen = defaultdict(list)
    for row in order:
        content = row[1].encode()
        for s in range(len(content) - stretch + 1):
            seen[content[s : s + stretch]] += [(row, s)] * (1 if first_stays else many[row])
    out = Counter()
    for row in order:
        content = row[1].encode()
        gone = bytearray(len(content))
        for s in range(len(content) - stretch + 1):
            places = seen[content[s : s + stretch]]
            if places[0] != (row, s) if first_stays else len(places) > 1:
                gone[s : s + stretch] = b"\1" * stretch
        runs = sum(1 for i in range(len(gone)) if gone[i] and (not i or not gone[i - 1]))
        kept = bytes(b for b, g in zip(content, gone) if not g)
        result = (row[0], len(content), sum(gone), runs, hashlib.sha256(kept).hexdigest(), kept)
        out[result] += many[row]
    return out


def got(spark, rows: list[tuple], **options) -> Counter:
    df = repeats.without_repeats(table(spark, rows), **options)
    assert df.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    return Counter((*r[:5], bytes(r[5]) if r[5] is not None else None) for r in df.collect())


def same(spark, rows, stretch, first_stays, **options):
    found = got(spark, rows, stretch=stretch, first_stays=first_stays, **options)
    expected = want(rows, stretch, first_stays)
    assert found == Counter({(*k[:5], k[5] if k[3] else None): n for k, n in expected.items()})


def passages(seed: int, documents: int = 60) -> list[tuple]:
    """Texts that share passages at their edges and inside, with edits, and periodic ones."""
    rng = random.Random(seed)
    shared = [sentence(rng, 30) for _ in range(4)]
    rows = []
    for i in range(documents):
        parts = [sentence(rng, rng.randint(0, 15))]
        for _ in range(rng.randint(0, 2)):
            passage = rng.choice(shared)
            cut = rng.randint(0, len(passage) // 2)
            parts += [passage[cut : cut + rng.randint(20, len(passage))], sentence(rng, rng.randint(0, 10))]
        if i % 3 == 0:
            parts += [shared[0]]
        if i % 10 == 0:
            parts += ["ab" * rng.randint(0, 60), "é" * rng.randint(0, 60)]
        rows.append((i, "".join(parts), "en"))
    return rows + [(1000 + i, rows[i][1], "en") for i in range(0, documents, 7)]


@pytest.mark.parametrize("first_stays", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_shared_passages(spark, seed, first_stays):
    same(spark, passages(seed), 40, first_stays)


@pytest.mark.parametrize("first_stays", [False, True])
def test_crowded_anchors_are_cut(spark, first_stays):
    same(spark, passages(3), 40, first_stays, crowd=3)


@pytest.mark.parametrize("first_stays", [False, True])
def test_odd_rows(spark, first_stays):
    rows = [r if r[0] != 4 else (4, r[1][:20_000], *r[2:]) for r in odd_rows()]
    same(spark, rows, 50, first_stays)
    assert not got(spark, rows[:1])[()]


def test_empty_table_and_no_repeats(spark):
    assert repeats.without_repeats(table(spark, odd_rows()).limit(0)).count() == 0
    rows = [(1, sentence(random.Random(1), 200)), (2, sentence(random.Random(2), 200)), (3, None)]
    assert all(r["n_removed"] == 0 for r in repeats.without_repeats(table(spark, rows)).collect())


def test_a_third_of_all_rows_is_one_row(spark):
    rows = [(7, "the very same text, again and again " * 8)] * 150 + passages(4, 30)
    same(spark, rows, 60, False)


def test_long_texts_run_over_chunks(monkeypatch):
    monkeypatch.setattr(anchors, "CHUNK", 300)
    rng = random.Random(6)
    texts = [bytes(rng.choice(b"ab") for _ in range(n)) for n in (0, 10, 59, 60, 61, 2000, 5000)]
    texts += [b"z" * 1500, texts[5][:700], b""]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    content = np.frombuffer(b"".join(texts), np.uint8)
    small = anchors.Anchors(60)
    cut = list(zip(*small.find(content, offsets)))
    monkeypatch.setattr(anchors, "CHUNK", 1 << 19)
    assert cut == list(zip(*anchors.Anchors(60).find(content, offsets)))
    # Every stretch belongs to one anchor, and equal stretches to equal ones at equal distance.
    chosen = defaultdict(set)
    count = Counter()
    for text, anchor, _, begin, end, place in cut:
        for s in range(begin, end - 60 + 1):
            count[text, s] += 1
            chosen[texts[text][s : s + 60]].add((anchor, begin + place - s))
    assert set(count.values()) == {1}
    assert set(count) == {(i, s) for i, t in enumerate(texts) for s in range(len(t) - 59)}
    assert all(len(c) == 1 for c in chosen.values())


@pytest.mark.parametrize("seed", range(4))
def test_longest_previous_factors(seed):
    rng = random.Random(seed)
    text = bytes(rng.choice(b"ab") for _ in range(120))
    order = np.array(sorted(range(len(text)), key=lambda i: text[i:]))

    def shared(a, b):
        n = 0
        while max(a, b) + n < len(text) and text[a + n] == text[b + n]:
            n += 1
        return n

    common = np.array([0] + [shared(a, b) for a, b in zip(order, order[1:])])
    factors = repeats.longest_previous(order, common)
    for i, position in enumerate(order):
        assert factors[i] == max((shared(p, position) for p in range(position)), default=0)


def test_bits_hold_all_keys(spark):
    df = spark.range(5000).select(F.xxhash64("id").alias("key"))
    keys = np.array([r[0] for r in df.collect()])
    bits = repeats.Bits(df, "key")
    assert bits.has(keys).all()
    others = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 20_000)
    assert bits.has(others).mean() < 0.1
    assert not repeats.Bits(df.limit(0), "key").has(keys).any()
