"""Encoding, decoding, counts and token files against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import time
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortloom.llm import bpe, queries, tokencount, tokenfiles

from .fixtures import odd_rows, table

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ALPHABET = "ab'sdrevlJ̌ΣςİI 　\x1c\x1d\x85\n\t\r  the,.!!99١éñ日本語😀‍̀ É"
PIECES = ["<|endoftext|>", " the", "aaaa", "a" * 300, "  ", "\n\n x", "'re", "'r", "'ll", "'s", " 123"]


def library(path: str) -> Tokenizer:
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def random_texts(seed: int) -> list[str]:
    rng = random.Random(seed)
    loose = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    return loose + ["".join(rng.choice(PIECES) for _ in range(rng.randint(1, 9))) for _ in range(500)]


def flat(encoder, texts):
    ids, sizes = encoder.encode(texts)
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]


def test_byte_pairs_equal_library():
    texts = random_texts(1)
    want = [e.ids for e in library(BYTES).encode_batch(texts, add_special_tokens=False)]
    assert flat(bpe.encoder(open(BYTES).read()), texts) == want


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 2000)
    own = bpe.Encoder(bpe.BytePairs(open(BYTES).read()))
    texts = random_texts(2)[:200]
    want = [e.ids for e in library(BYTES).encode_batch(texts, add_special_tokens=False)]
    assert [x for t in texts for x in flat(own, [t])] == want


def test_long_words_equal_library():
    rng = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = ["".join(rng.choice(letters) for _ in range(1_000_000)), "a" * 100_001, "ab" * 5000]
    texts += ["".join(map(chr, rng.choices(range(0x4E00, 0x9FFF), k=20_000)))]
    texts += ["".join(rng.choices("aéx ", k=n)) + "abc" * n for n in (85, 86, 255, 256, 257, 900)]
    want = [e.ids for e in library(BYTES).encode_batch(texts, add_special_tokens=False)]
    own = bpe.Encoder(bpe.BytePairs(open(BYTES).read()))
    start = time.perf_counter()
    assert flat(own, texts) == want
    assert time.perf_counter() - start < 30
    # They are not kept.
    assert own.known.held < 100_000 and max(map(len, own.known.number)) <= bpe.LONG
    assert flat(own, texts[3:]) == want[3:]


def test_both_ways_of_merging_agree(monkeypatch):
    pairs = bpe.encoder(open(BYTES).read()).pairs
    words = [w.encode() for t in random_texts(8) for w in t.split(" ")]
    ids, sizes = pairs.merge(words)
    monkeypatch.setattr(bpe, "LONG", 2)
    other, other_sizes = pairs.merge(words)
    assert (ids == other).all() and (sizes == other_sizes).all()


def test_known_words_are_bounded_by_bytes():
    known = bpe.Known()
    for i in range(3000):
        known.add([f"w{i}", f"v{i}"], np.arange(5), np.array([2, 3]))
    ids, sizes = known.take(np.array([1, 5999, 0]))
    assert ids.tolist() == [2, 3, 4, 2, 3, 4, 0, 1] and sizes.tolist() == [3, 3, 2]
    held = known.held
    known.add(["long"], np.arange(9), np.array([9]))
    known.forget(["long"], 9)
    assert known.held == held > 6000 * 200 and "long" not in known.number
    known.met(np.arange(6000))
    known.met(np.array([7, 1]))
    kept = known.often()
    assert list(kept.number) == ["v0", "v3"] and kept.held < known.held
    assert kept.take(np.array([1, 0]))[0].tolist() == known.take(np.array([7, 1]))[0].tolist()
    # Not used again, or used by most: nothing stays.
    assert not kept.often().number


def test_overlapping_pairs_join_from_the_left():
    own = bpe.encoder(open(BYTES).read())
    texts = ["a" * n for n in range(40)]
    want = [e.ids for e in library(BYTES).encode_batch(texts, add_special_tokens=False)]
    assert flat(own, texts) == want


@pytest.mark.parametrize("chunk", [3, 7, 512])
def test_counts_equal_library(monkeypatch, chunk):
    monkeypatch.setattr(tokencount, "CHUNK", chunk)
    texts = random_texts(chunk)
    want = [len(e.ids) for e in library(BYTES).encode_batch(texts, add_special_tokens=False)]
    assert tokencount.counter(open(BYTES).read()).count(texts).tolist() == want


def test_counter_starts_anew(monkeypatch):
    monkeypatch.setattr(tokencount, "STATES", 50)
    own = tokencount.TokenCounter(open(BYTES).read())
    texts = random_texts(4)[-300:]
    want = [len(e.ids) for e in library(BYTES).encode_batch(texts, add_special_tokens=False)]
    assert [int(own.count([t])[0]) for t in texts] == want


def test_prefix_scan_composes_maps():
    rng = np.random.default_rng(1)
    maps = rng.integers(0, 12, (37, 12)).astype(np.uint8)
    state, want = np.arange(12), []
    for m in maps:
        want.append(state)
        state = m[state]
    assert tokencount.scanned(maps).tolist() == [w.tolist() for w in want]


def test_word_vocabulary_equals_library():
    texts = random_texts(5)
    want = [e.ids for e in library(WORDS).encode_batch(texts, add_special_tokens=False)]
    assert flat(tokenfiles.encoder(open(WORDS).read()), pa.array(texts)) == want


def test_word_vocabulary_over_code_points(monkeypatch):
    monkeypatch.setattr(tokenfiles, "CACHED", 100_000)
    rng = random.Random(6)
    points = [chr(c) for c in range(0x3000)]
    points += [chr(c) for c in rng.sample([*range(0x3000, 0xD800), *range(0xE000, 0x110000)], 5000)]
    texts = [form.format(c) for c in points for form in ("{}", "x{}Y", " A {0} \n b{0}")]
    want = [e.ids for e in library(WORDS).encode_batch(texts, add_special_tokens=False)]
    own = tokenfiles.ChunkEncoder(open(WORDS).read())
    got = [x for i in range(0, len(texts), 500) for x in flat(own, pa.array(texts[i : i + 500]))]
    assert got == want


class Counting:
    """Passes texts on to a tokenizer and counts them."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


@pytest.mark.parametrize("marks", [True, False])
def test_new_words_are_encoded_many_in_a_text(marks):
    rng = random.Random(4)
    letters = "abcdefghé日жñ"
    words = list({"".join(rng.choice(letters) for _ in range(rng.randint(1, 12))) for _ in range(3000)})
    # Letters, digits and marks that the library may take for something else than Python does.
    words += ["x" * 3000, "ab1", "12", "'s", "it's", "Ⅷ", "²", "ªº", "ʰʲ", "ၐ", "ꟊa", "\U00011f02b", "\U0001e4d0", "\u2060a", "a\ufeffb"]
    own = tokenfiles.ChunkEncoder(open(WORDS).read())
    own.tokenizer = Counting(own.tokenizer)
    if not marks:
        own.final[:] = False
    rows = [" ".join(words[i : i + 7]) + "." for i in range(0, len(words), 7)]
    lib = library(WORDS)
    assert flat(own, pa.array(rows)) == [e.ids for e in lib.encode_batch(rows, add_special_tokens=False)]
    assert (own.tokenizer.texts < 200) == marks


def test_runs_of_rows():
    assert tokenfiles.runs(np.array([3, 3, 9, 1, 1]), 6) == [2, 1, 2]
    assert tokenfiles.runs(np.array([], int)) == [] and tokenfiles.runs(np.array([7]), 6) == [1]


def test_operators_on_odd_rows(spark):
    docs = table(spark, odd_rows())
    encoded = bpe.encoded(docs.drop("ids"), BYTES)
    back = bpe.decoded(encoded, BYTES).withColumn("digest", bpe.ids_sha256())
    rows = tokencount.counted(back, BYTES).collect()
    assert len(rows) == docs.count()
    lib = library(BYTES)
    for r in rows:
        want = lib.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == want and r["n_tokens"] == len(want)
        assert r["decoded"] == lib.decode(want, skip_special_tokens=False)
        assert r["digest"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r["words"] == "words"
    trip = bpe.round_trip(docs, BYTES).select("text", "size", "coded.*").collect()
    assert len(trip) == docs.count()
    for r in trip:
        want = lib.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(want) and r["size"] == "size"
        assert r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    assert bpe.round_trip(docs.limit(0), BYTES).count() == 0
    empty = bpe.encoded(docs.limit(0), BYTES)
    assert bpe.decoded(empty, BYTES).count() == tokencount.counted(empty, BYTES).count() == 0


def test_token_files(spark, tmp_path):
    docs = table(spark, odd_rows()).repartition(5)
    tokenfiles.write_token_files(docs, f"{tmp_path}/a", WORDS)
    files = tokenfiles.read_token_files(spark, f"{tmp_path}/a")
    rows = files.withColumn("crc", tokenfiles.ids_crc32()).orderBy("start").collect()
    lib, start = library(WORDS), 0
    want = sorted(odd_rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert [r["doc_id"] for r in rows] == [w[0] for w in want]
    for r, w in zip(rows, want, strict=True):
        ids = lib.encode(w[1] or "", add_special_tokens=False).ids + [1]
        assert (r["start"], r["n_tokens"], r["ids"]) == (start, len(ids), ids)
        assert r["crc"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    # Ids are not shuffled to meet the numbers of their files.
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "ids" not in "".join(x for x in plan.split("\n") if "Exchange" in x)
    # Ids are left alone when only the numbers beside them are asked for.
    plan = files.select("doc_id", "start")._jdf.queryExecution().executedPlan().toString()
    assert "ids:array" not in plan
    tokenfiles.write_token_files(docs.limit(0), f"{tmp_path}/b", WORDS)
    assert tokenfiles.read_token_files(spark, f"{tmp_path}/b").count() == 0


def test_files_are_encoded_as_said(spark, tmp_path):
    import pyarrow.parquet as pq

    tokenfiles.write_token_files(table(spark, odd_rows()), f"{tmp_path}/a", WORDS)
    meta = [pq.ParquetFile(p).metadata for p in sorted(tmp_path.glob("a/part-*"))]
    columns = {}
    for m in meta:
        for i in range(m.num_row_groups):
            for j in range(m.num_columns):
                c = m.row_group(i).column(j)
                columns[c.path_in_schema] = c
    assert "DELTA_BINARY_PACKED" in columns["local_start"].encodings
    assert any("DICTIONARY" in e for e in columns["ids.list.element"].encodings)
    assert columns["doc_id"].has_offset_index and columns["doc_id"].has_column_index


@pytest.mark.parametrize("name", ["op1_bpe", "op9_token_files", "op10_token_counts"])
def test_queries_return_all_documents(spark, name):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = queries.queries()[name](spark, folder)
    assert got.count() == docs.count()
    lib = library(WORDS if "files" in name else BYTES)
    sizes = {r["doc_id"]: r["n_tokens"] for r in got.collect()}
    for r in docs.select("doc_id", F.col("text")).collect():
        n = len(lib.encode(r["text"] or "", add_special_tokens=False).ids)
        assert sizes[r["doc_id"]] == n + (1 if "files" in name else 0)
