"""Small document tables with everything that may go wrong in them."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; documents may have such columns too.
CLASHES = (
    "words", "size", "key", "document", "kept", "rows", "position", "recipe", "ids", "lines",
    "body", "place", "covered", "h1", "k1", "quality", "component", "best", "order", "target",
)
LONG = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do. " * 3000


def table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """doc_id and text, and if given lang and source; columns with clashing names beside them."""
    full = [tuple(r) + (None,) * (4 - len(r)) + (len(r[1] or ""),) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    return df.withColumns({c: F.lit(c) for c in CLASHES})


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5))) for _ in range(n))


def odd_rows(seed: int = 3) -> list[tuple]:
    """Nulls anywhere, empty and long texts, ties, repeated rows."""
    rng = random.Random(seed)
    base = sentence(rng, 80)
    words = base.split()
    near = " ".join([*words[:40], "changed", *words[41:]])
    rows = [
        (1, base, "en", "a"), (2, None, "en", "a"), (3, "", None, None), (4, LONG, "en", "b"),
        (5, base, "fr", None), (5, base, "fr", None), (6, near, None, "b"), (7, " \n\t ", "en", "b"),
        (None, base, "en", "a"), (None, None, None, None), (8, "one", "en", "c"), (9, "one", "de", "c"),
        (10, "x\ny\nz\nw", "en", "c"), (11, "x\ny\nz\nw", "en", "c"), (12, "a b\n\n c d \r\ny\nz\nw", "en", "a"),
        (13, "日本語 text 😀 é", "en", "é"), (14, "<|endoftext|> ends <|endoftext|>", "en", "a"),
    ]
    return rows + [(100 + i, sentence(rng, rng.randint(1, 120)), "en", f"s{i % 4}") for i in range(20)]


def split_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
