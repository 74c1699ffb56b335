"""Ordered rules that read a free-text result.  Fixed values; the first match decides."""

from __future__ import annotations

from dataclasses import dataclass

from ..functions.patterns import (
    Pattern, contains, equal, fragments, fragments_at_end, prefix, regex,
)
from ..functions.scalars import NUMERIC_TEXT

POSITIVE = "Positive"
NEGATIVE = "Negative"
COMPLETED = "Completed"

VALUE = "ORD_VALUE"
COMMENT = "COMPONENT_COMMENT"
STRIPPED = "ORD_VALUE_REPLACED"


@dataclass(frozen=True)
class ResultRule:
    """``label`` when ``column`` matches ``pattern`` (and the test is of ``test_type``)."""

    label: str
    column: str
    pattern: Pattern
    test_type: str | None = None


# Values that say no usable result came out: invalid, indeterminate, not performed, equivocal.
UNUSABLE_MARKS: tuple[str, ...] = ("INVALID", "INDETER", "TNP", "EQ")

# Read on upper-cased value and comment.
HEPATITIS_RULES: tuple[ResultRule, ...] = (
    ResultRule(POSITIVE, VALUE, regex("(?s)<[0-9].*DETECTED", needs=("<", "DETECTED"))),
    ResultRule(POSITIVE, VALUE, regex("[1-6]"), test_type="Genotype"),
    ResultRule(NEGATIVE, COMMENT, fragments("NON", "REACTIVE")),
    ResultRule(NEGATIVE, COMMENT, fragments("NOT", "DETECTED")),
    ResultRule(NEGATIVE, COMMENT, contains("LESS THAN")),
    ResultRule(NEGATIVE, COMMENT, contains("<")),
    ResultRule(NEGATIVE, VALUE, contains("NON")),
    ResultRule(NEGATIVE, VALUE, fragments_at_end("NOT", "DETECTED")),
    ResultRule(NEGATIVE, VALUE, contains("<")),
    ResultRule(POSITIVE, VALUE, contains("REACTIVE")),
    ResultRule(POSITIVE, VALUE, contains("DETECTED")),
    ResultRule(POSITIVE, VALUE, regex("[0-9]")),
    ResultRule(POSITIVE, COMMENT, contains("REPEATEDLY")),
    ResultRule(POSITIVE, COMMENT, contains("CONFIRMATION")),
    ResultRule(POSITIVE, COMMENT, contains("DETECTED")),
    ResultRule(POSITIVE, COMMENT, contains("GREATER THAN")),
    ResultRule(POSITIVE, COMMENT, contains(">")),
)

# Read on the text as it was entered.
HIV_RULES: tuple[ResultRule, ...] = (
    ResultRule(NEGATIVE, VALUE, prefix("N")),
    ResultRule(POSITIVE, VALUE, fragments("<", "Detected")),
    ResultRule(NEGATIVE, VALUE, contains("<")),
    ResultRule(NEGATIVE, VALUE, contains("Target Not")),
    ResultRule(POSITIVE, VALUE, prefix("R")),
    ResultRule(POSITIVE, VALUE, prefix("P")),
    ResultRule(POSITIVE, COMMENT, contains("REPEATEDLY")),
    ResultRule(POSITIVE, COMMENT, contains("repeatedly")),
    ResultRule(POSITIVE, STRIPPED, regex(NUMERIC_TEXT), test_type="RNA"),
    ResultRule(POSITIVE, VALUE, equal("DETECTED"), test_type="RNA"),
)

# Comment lines that state a positive differentiation result (read upper-cased).
POSITIVE_COMMENT_MARKS: tuple[str, ...] = ("HIV-1 POSITIVE", "HIV-2 POSITIVE")
