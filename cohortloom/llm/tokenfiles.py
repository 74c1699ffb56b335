"""Token files: ids as Parquet list columns, written in document order and read back in part."""

from __future__ import annotations

import json
import os
import re
import string
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .bpe import Known, printable, vocabulary
from .common import durable, durable_folder

END_ID = 1
#: Row groups hold whole documents of about so many bytes, pages about so many; each page of each
#: column is listed with its bounds, so that a reader finds documents without reading the others.
ROW_GROUP, PAGE = 32 << 20, 256 << 10
#: Bytes of chunks that a worker remembers about, and bytes of text it works on at once.
CACHED, PORTION = 112 << 20, 4 << 20
#: Words of letters that are encoded in one text, and texts whose ids are Python objects at once.
TOGETHER, AT_ONCE = 64, 256
SCHEMA = "doc_id long, part int, local_start long, n_tokens long, ids array<int>"


class ChunkEncoder:
    """Encodes with the tokenizers library, each chunk between white space once.

    For vocabularies that compose (NFC) and lower-case texts, whose words never hold white space, so
    that chunks do not touch each other, nor letters together with marks that end a chunk. Usual texts are lower-cased, cut and numbered by Arrow,
    and only chunks that a worker has not met become Python objects.
    """

    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = json.loads(content)
        self.normalizer = Tokenizer.from_str(content).normalizer
        # Chunks are normalised before they are looked up, so not again when they are encoded.
        self.tokenizer = Tokenizer.from_str(json.dumps(model | {"normalizer": None}))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # Which ids end a word, if every word ends with such a one.
        mark, ids = model["model"].get("end_of_word_suffix"), model["model"]["vocab"]
        self.final = None
        if mark and all(c + mark in ids for c in printable()):
            self.final = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
            self.final[[i for token, i in ids.items() if token.endswith(mark)]] = True
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = special
        self.cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.spaces = regex.compile(r"\p{White_Space}+")
        # Texts with special tokens, and those for whose letters Arrow and the library may differ:
        # separators that are no white space, a letter that becomes two, all that may compose.
        self.unusual = "|".join(
            [r"[\x1c-\x1f\x{130}\x{300}-\x{10ffff}]", *map(re.escape, special)]
        )
        self.known = Known()

    def split(self, text: str) -> list[str]:
        out: list[str] = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                out.append(part)
            else:
                out += [c for c in self.spaces.split(self.normalizer.normalize_str(part)) if c]
        return out

    def chunks(self, texts: pa.Array) -> pa.ListArray:
        """The chunks of each text, white space cut off."""
        odd = pc.match_substring_regex(texts, self.unusual)
        # White space at the ends would give empty chunks.
        usual = pc.utf8_trim_whitespace(pc.utf8_lower(pc.if_else(odd, "", texts)))
        cut = pc.utf8_split_whitespace(usual)
        if not pc.any(odd).as_py():
            return cut
        which = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        own = pa.array([self.split(texts[i].as_py()) for i in which.tolist()], pa.list_(pa.string()))
        order = np.arange(len(texts))
        order[which] = len(texts) + np.arange(len(which))
        return pa.concat_arrays([cut, own]).take(pa.array(order))

    def alone(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts, each a text, in one array, and how many each has."""
        ids, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for begin in range(0, len(parts), AT_ONCE):
            few = parts[begin : begin + AT_ONCE]
            got = [e.ids for e in self.tokenizer.encode_batch_fast(few, add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, got), np.int64, len(got)))
            ids.append(np.fromiter(chain.from_iterable(got), np.int32, int(sizes[-1].sum())))
        return np.concatenate(ids), np.concatenate(sizes)

    def together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """`alone` for words of letters only: texts hold many, told apart by the ids that end one.

        A word of letters is never joined with another over a blank, and is cut only where the
        library takes a character for something else. Then more words end than there are.
        """
        if self.final is not None:
            texts = [" ".join(words[i : i + TOGETHER]) for i in range(0, len(words), TOGETHER)]
            ids, _ = self.alone(texts)
            ends = np.flatnonzero(self.final[ids])
            if len(ends) == len(words):
                return ids, np.diff(ends, prepend=-1)
        return self.alone(words)

    def learn(self, chunks: list[str]) -> None:
        """Remembers the ids of chunks not known so far; a word before marks is encoded without."""
        known = self.known
        cores = [c.rstrip(string.punctuation) for c in chunks]
        ended = [(c, core) for c, core in zip(chunks, cores) if core != c and core.isalpha()]
        parts = [c for c, core in zip(chunks, cores) if core == c or not core.isalpha()]
        for chunk, core in ended:
            parts += [core, chunk[len(core) :]]
        parts = [p for p in dict.fromkeys(parts) if p not in known.number]
        words = [p for p in parts if p.isalpha()]
        known.add(words, *self.together(words))
        others = [p for p in parts if not p.isalpha()]
        known.add(others, *self.alone(others))
        if ended:
            place = [known.number[p] for c, core in ended for p in (core, c[len(core) :])]
            ids, sizes = known.take(np.array(place))
            known.add([c for c, _ in ended], ids, sizes.reshape(-1, 2).sum(axis=1))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (none missing) in one array, and how many each has."""
        if self.known.held > CACHED:
            self.known = self.known.often()
        known, cut = self.known, self.chunks(texts)
        flat = cut.flatten()
        # An empty text is cut to one empty chunk.
        coded = flat.dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        number = np.fromiter(map(known.number.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(number < 0)
        if len(new):
            unseen = [names[i] for i in new.tolist()]
            self.learn(unseen)
            number[new] = np.fromiter(map(known.number.__getitem__, unseen), np.int64, len(unseen))
        known.met(number)
        ids, size = known.take(number[coded.indices.to_numpy(zero_copy_only=False)])
        counts = cut.value_lengths().to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum(counts)]
        return ids, np.diff(np.concatenate([[0], ends]))


_encoders: dict[int, ChunkEncoder] = {}


def encoder(content: str) -> ChunkEncoder:
    key = hash(content)
    if key not in _encoders:
        _encoders[key] = ChunkEncoder(content)
    return _encoders[key]


def runs(lengths: np.ndarray, most: int = PORTION) -> list[int]:
    """Numbers of neighbouring rows that hold about so many bytes together, a longer one alone."""
    out, held, begin = [], 0, 0
    for row, length in enumerate(lengths.tolist()):
        if row > begin and held + length > most:
            out.append(row - begin)
            begin, held = row, 0
        held += length
    return [*out, len(lengths) - begin] if len(lengths) else out


def with_end(ids: np.ndarray, sizes: np.ndarray, end: int) -> np.ndarray:
    """The ids with `end` after each text."""
    out = np.full(len(ids) + len(sizes), end, np.int32)
    ends = np.cumsum(sizes + 1) - 1
    own = np.ones(len(out), bool)
    own[ends] = False
    out[own] = ids
    return out


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
) -> None:
    """Writes doc_id, part, local_start, n_tokens and ids of each text, in ascending doc_id order.

    Files part-00000, part-00001, ... hold ascending ranges of doc_id, rows ascend in them; rows of
    one doc_id ascend by text. `ids` are those of the tokenizers library for the vocabulary file
    `tokenizer`, without special tokens around, then `end_id`; they are dictionary-encoded, the
    numbers beside them as differences. local_start counts the ids before a row in its file. A
    missing or empty text has the end id only; a missing doc_id comes first. Other columns are not
    written. The empty table leaves a folder with no rows.
    """
    spark = docs.sparkSession
    held = vocabulary(spark, tokenizer)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, before = encoder(held.value), TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            row = 0
            for rows in runs(pc.binary_length(texts).to_numpy(zero_copy_only=False)):
                run = texts.slice(row, rows)
                ids, sizes = own.encode(run)
                ids, sizes = with_end(ids, sizes, end_id), sizes + 1
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, len(run)),
                        pa.array(np.full(len(run), part, np.int32)),
                        pa.array(before + ends - sizes),
                        pa.array(sizes),
                        pa.ListArray.from_arrays(
                            pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids)
                        ),
                    ],
                    ["doc_id", "part", "local_start", "n_tokens", "ids"],
                )
                before += int(ends[-1])
                row += len(run)

    (
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(encode, SCHEMA)
        .write.option("compression", "zstd")
        .option("parquet.block.size", ROW_GROUP)
        .option("parquet.page.size", PAGE)
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary#doc_id", "false")
        .option("parquet.enable.dictionary#local_start", "false")
        .option("parquet.enable.dictionary#n_tokens", "false")
        .parquet(folder)
    )


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids of each document.

    start counts the ids of all documents before it, in all files. Only the columns and, by the
    bounds in the files, the pages that a query wants are read.
    """
    files = spark.read.schema(SCHEMA).parquet(folder)
    # One row of two numbers per file, of which there are as many as the writing job had tasks: some
    # hundred thousand at most. The ids themselves are not moved to meet them.
    offsets = durable(
        files.groupBy("part")
        .agg(F.sum("n_tokens").alias("in_part"))
        .select(
            "part",
            F.coalesce(
                F.sum("in_part").over(
                    Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ).alias("part_start"),
        )
    )
    return files.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("part_start") + F.col("local_start")).alias("start"), "n_tokens", "ids"
    )


def new_folder(spark: SparkSession) -> str:
    """A folder of its own for token files, beside the checkpoints; it is the caller's to remove."""
    return f"{durable_folder(spark)}/token-files-{uuid.uuid4().hex}"


def ids_crc32(ids: str = "ids") -> Column:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf(LongType())
    def checksum(column: pa.Array) -> pa.Array:
        flat = column.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        ends = np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).tolist()
        out, start = [], 0
        for end in ends:
            out.append(zlib.crc32(flat[start:end]))
            start = end
        return pa.array(out, pa.int64())

    return checksum(F.col(ids))
