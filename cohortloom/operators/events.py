"""First date, last date and presence of events per entity.

Every operator here is one conditional aggregate: each row is marked with the events it
is evidence for, then one ``groupBy`` reduces the marks.  Minimum and maximum are combined
before the shuffle, so a key holding a large share of the rows sends one row per task.
Marks from different tables can be stacked with :func:`stack_marks` and reduced together,
which replaces one shuffle and one join per evidence kind by a single shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PATIENT = "PAT_ID"
_SEEN = "__seen"


def mark_events(
    df: DataFrame,
    events: Mapping[str, tuple[Column, Column]],
    key: str = PATIENT,
    drop_unmarked: bool = True,
) -> DataFrame:
    """``key`` plus one column per event: its value where the condition holds, else NULL.

    ``events`` maps a name to (condition, value).  Rows that are no evidence for any event are
    left out; where next to none is, ``drop_unmarked=False`` saves the test.
    """
    if drop_unmarked:
        df = df.filter(reduce(or_, [cond for cond, _ in events.values()]))
        if len(events) == 1:
            # Every row left is marked; testing again would double the generated code.
            [(name, (_, value))] = events.items()
            return df.select(key, value.alias(name))
    return df.select(
        key, *(F.when(cond, value).alias(name) for name, (cond, value) in events.items())
    )


def stack_marks(frames: Iterable[DataFrame]) -> DataFrame:
    """Marks of several tables under each other, absent columns NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def first_per_key(marks: DataFrame, key: str = PATIENT) -> DataFrame:
    """Smallest value of every mark per key."""
    return _reduce_marks(marks, F.min, key)


def last_per_key(marks: DataFrame, key: str = PATIENT) -> DataFrame:
    """Largest value of every mark per key."""
    return _reduce_marks(marks, F.max, key)


def _reduce_marks(marks: DataFrame, pick, key: str) -> DataFrame:
    return marks.groupBy(key).agg(*(pick(c).alias(c) for c in marks.columns if c != key))


def first_events(
    df: DataFrame,
    events: Mapping[str, Column],
    time: str,
    key: str = PATIENT,
    filter_rows: bool = True,
) -> DataFrame:
    """First time of each kind of event per key (keys without any event are left out).

    Rows without an event are filtered out before the aggregate, or with
    ``filter_rows=False`` keys are after it.  Take the latter for conditions on classified
    columns: a row filter on those is pushed below the classification and runs it once more
    for every mention.
    """
    return _event_times(df, events, time, key, filter_rows, first_per_key)


def last_events(
    df: DataFrame,
    events: Mapping[str, Column],
    time: str,
    key: str = PATIENT,
    filter_rows: bool = True,
) -> DataFrame:
    """Last date of each kind of event per key; ``filter_rows`` as for :func:`first_events`."""
    return as_dates(_event_times(df, events, time, key, filter_rows, last_per_key), events)


def _event_times(df, events, time, key, filter_rows, per_key) -> DataFrame:
    marks = {n: (cond, F.col(time)) for n, cond in events.items()}
    if filter_rows:
        return per_key(mark_events(df, marks, key), key)
    # An event may lack its time, so the times alone do not tell which keys have one.
    marks[_SEEN] = (reduce(or_, events.values()), F.lit(1))
    seen = per_key(mark_events(df, marks, key, drop_unmarked=False), key)
    return seen.filter(F.col(_SEEN).isNotNull()).drop(_SEEN)


def presence_flags(
    df: DataFrame, events: Mapping[str, Column], key: str = PATIENT, filter_rows: bool = True
) -> DataFrame:
    """1 for each kind of event a key has, NULL for the others; keys with none are left out.

    ``filter_rows`` as for :func:`first_events`.
    """
    marks = {n: (cond, F.lit(1)) for n, cond in events.items()}
    flags = last_per_key(mark_events(df, marks, key, drop_unmarked=filter_rows), key)
    return flags if filter_rows else flags.filter(F.coalesce(*events).isNotNull())


def latest_row(
    df: DataFrame, order_by: Sequence[str], columns: Sequence[str], key: str = PATIENT
) -> DataFrame:
    """``key``, ``order_by`` and ``columns`` of each key's row that comes last in that order.

    The row a descending ``row_number() == 1`` would keep (NULL counts as earliest, and rows
    equal in ``order_by`` are decided by ``columns``), found by an aggregate: every task sends
    one row per key, and no key's rows have to be sorted together.
    """
    names = tuple(dict.fromkeys((*order_by, *columns)))
    return (
        df.groupBy(key)
        .agg(F.max(F.struct(*names)).alias("__last"))
        .select(key, *(f"__last.{n}" for n in names))
    )


def as_dates(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop the time of day from the named columns."""
    return df.withColumns({c: F.col(c).cast("date") for c in columns})
