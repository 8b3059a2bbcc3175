"""Numbers held as text: thousands commas, placeholders, stray blanks.

Everything here is a built-in expression, so it stays inside code generation, and
every cast is a ``try_cast`` behind the pattern, so the result is the same with ANSI
mode on and off.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what counts as a number once blanks and commas are gone. \z, not $,
# because Java's $ would also accept a final newline.
NUMBER_PATTERN = r"^-?\d+(\.\d+)?\z"


def bare_number_text(text: Column) -> Column:
    """The text without outer blanks (U+0020 only) and without any comma."""
    return F.replace(F.trim(text), F.lit(","), F.lit(""))


def is_number(text: Column) -> Column:
    """True for a clean number, false for any other text, NULL for NULL."""
    return bare_number_text(text).rlike(NUMBER_PATTERN)


def is_invalid_number(text: Column) -> Column:
    """Present but not a number. A NULL cell is missing, not invalid."""
    return text.isNotNull() & ~is_number(text)


def parse_number(text: Column, to: str) -> Column:
    """Number of type ``to`` ("double" or "bigint"), NULL where the text is not one.

    A decimal read as bigint is cut toward zero; a value out of range is NULL.
    """
    bare = bare_number_text(text)
    if to == "bigint":
        number = F.substring_index(bare, ".", 1)
    elif to == "double":
        number = bare
    else:
        raise ValueError(f"a number column is read as 'double' or 'bigint', not {to!r}")
    return F.when(bare.rlike(NUMBER_PATTERN), number.try_cast(to))
