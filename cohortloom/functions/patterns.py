"""Text predicates used by every rule list.

A :class:`Pattern` is a piece of data (it can sit in a rule table) that turns
into a native Spark predicate.  All of them follow SQL three-valued logic: a
NULL text gives a NULL answer, so negated patterns do not keep NULL rows unless
:func:`or_null` says so.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Pattern:
    """One text test; build it with the helpers below."""

    kind: str
    parts: tuple[str, ...]
    needs: tuple[str, ...] = ()

    def on(self, text: Column, ignore_case: bool = False) -> Column:
        """The predicate "``text`` matches this pattern"."""
        parts, needs = self.parts, self.needs
        if self.kind == "regex":
            test = text.rlike(("(?i)" if ignore_case else "") + parts[0])
            # A plain substring test is far cheaper than the regex engine, so
            # the literals every match must hold are looked for first.
            folded = F.upper(text) if ignore_case else text
            cheap = [folded.contains(n.upper() if ignore_case else n) for n in needs]
            return reduce(and_, [*cheap, test])

        if ignore_case:
            text, parts = F.upper(text), tuple(p.upper() for p in parts)
        if self.kind == "contains":
            return text.contains(parts[0])
        if self.kind == "prefix":
            return text.startswith(parts[0])
        if self.kind == "equal":
            # Trailing blanks do not count in an equality.  The prefix test is
            # implied by the equality; unlike the trimmed form it reaches the
            # parquet scan.
            return text.startswith(parts[0]) & (F.rtrim(text) == parts[0])
        ordered = "%" + "%".join(_like_literal(p) for p in parts)
        if self.kind == "fragments_at_end":
            text = F.rtrim(text)  # nor do they count behind the end of a pattern
        else:
            ordered += "%"
        return reduce(and_, [*(text.contains(p) for p in parts), text.like(ordered)])


def _like_literal(text: str) -> str:
    for mark in ("\\", "%", "_"):
        text = text.replace(mark, "\\" + mark)
    return text


def contains(text: str) -> Pattern:
    """``text`` occurs anywhere."""
    return Pattern("contains", (text,))


def prefix(text: str) -> Pattern:
    """The value starts with ``text``."""
    return Pattern("prefix", (text,))


def equal(text: str) -> Pattern:
    """The value is ``text``, trailing blanks aside."""
    return Pattern("equal", (text,))


def fragments(*parts: str) -> Pattern:
    """The parts occur in this order, anything between and around them."""
    return Pattern("fragments", parts)


def fragments_at_end(*parts: str) -> Pattern:
    """As :func:`fragments`, the last part ending the value."""
    return Pattern("fragments_at_end", parts)


def regex(pattern: str, needs: Iterable[str] = ()) -> Pattern:
    """A regular expression found anywhere; ``needs`` are literals it implies."""
    return Pattern("regex", (pattern,), tuple(needs))


def any_of(text: Column, patterns: Iterable[Pattern], ignore_case: bool = False) -> Column:
    """At least one pattern matches."""
    return reduce(or_, [p.on(text, ignore_case) for p in patterns])


def none_of(text: Column, patterns: Iterable[Pattern], ignore_case: bool = False) -> Column:
    """No pattern matches; NULL text stays NULL."""
    return ~any_of(text, patterns, ignore_case)


def any_word(text: Column, words: Iterable[str], ignore_case: bool = False) -> Column:
    """At least one of the words occurs in the text."""
    return any_of(text, [contains(w) for w in words], ignore_case)


def is_one_of(text: Column, values: Iterable[str], ignore_case: bool = False) -> Column:
    """The value is one of ``values``, trailing blanks aside."""
    values = tuple(v.upper() if ignore_case else v for v in values)
    text = F.upper(text) if ignore_case else text
    return reduce(or_, [text.startswith(v) for v in values]) & F.rtrim(text).isin(*values)


def or_null(test: Column, text: Column) -> Column:
    """Let NULL text pass a test that would otherwise drop it."""
    return test | text.isNull()
