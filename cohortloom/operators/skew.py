"""Joining a table, however unevenly keyed, to a lookup with about one row per key.

A lookup is usually the output of an aggregate and so already spread by the key.  Spark would
join on top of that, and then adaptive execution has no shuffle of the lookup to read twice:
it cannot split a partition in which one key (or NULL) holds a large share of the other side's
rows.  :func:`lookup_join` makes the join shuffle both sides, which lets it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPREAD = "__spread"


def lookup_join(
    facts: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join ``facts`` to ``lookup`` on ``keys``; ``how`` is ``left`` or ``inner``.

    The join key carries a hash of itself, so neither side's earlier spread serves the join
    and both get a shuffle of their own.  A lookup Spark finds small enough is broadcast as in
    any join; otherwise a skewed partition of the facts is cut into pieces
    (``spark.sql.adaptive.skewJoin``), each meeting its own copy of the lookup's partition.
    The price is one more shuffle of the lookup, which has one row per key.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    spread = F.xxhash64(*keys)
    return (
        facts.withColumn(_SPREAD, spread)
        .join(lookup.withColumn(_SPREAD, spread), [*keys, _SPREAD], how)
        .drop(_SPREAD)
    )
