"""Column expressions that several operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, functions as F

# The white space of the contracts, space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, other letters as they are; all-ASCII texts take the fast built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def field(row: Column, name: str) -> Column:
    """A column of the input out of the struct that carries it, under its own name."""
    return row.getField(name).alias(name)


def row_of(columns: list[str]) -> Column:
    """The given columns as one struct, so that none of their names meets a helper column's."""
    return F.struct(*[F.col(f"`{c}`") for c in columns])
