"""Text functions with the feed's trimming, blank and integer rules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Trimming strips every character up to U+0020 at both ends.
TRIMMED = "".join(chr(c) for c in range(0x21))

# A line made only of these characters counts as blank (white
# space without the non-breaking spaces U+00A0, U+2007 and U+202F).
BLANK = "".join(
    chr(c)
    for c in (
        *range(0x09, 0x0E),
        *range(0x1C, 0x21),
        0x1680,
        *range(0x2000, 0x2007),
        *range(0x2008, 0x200B),
        0x2028,
        0x2029,
        0x205F,
        0x3000,
    )
)


def is_blank(value: Column) -> Column:
    """True for null, empty and whitespace-only text."""
    return value.isNull() | (F.btrim(value, F.lit(BLANK)) == "")


def trim_controls(value: Column) -> Column:
    """Strip blanks and control characters at both ends; ``F.trim`` would
    leave tabs and newlines."""
    return F.btrim(value, F.lit(TRIMMED))


def strict_int(value: Column) -> Column:
    """Text of an optional sign and digits as int; anything else is NULL."""
    return F.when(value.rlike("^[+-]?[0-9]+$"), value.try_cast("int"))


def strict_long(value: Column) -> Column:
    """The same as a 64-bit number."""
    return F.when(value.rlike("^[+-]?[0-9]+$"), value.try_cast("bigint"))


def rarely(value: Column, expression: Callable[[Column], Column]) -> Column:
    """``expression(value)``, kept out of the generated code of its stage.

    A lambda of a higher-order function is interpreted. That costs little for
    the few rows that need it, and keeps the code of all other rows under the
    size (8,000 bytes a method) beyond which the JVM stops compiling it."""
    return F.get(F.transform(F.array(value), expression), F.lit(0))
