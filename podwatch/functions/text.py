"""Text expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(text: Column) -> Column:
    """True for NULL and for the empty string."""
    return F.coalesce(text, F.lit("")) == ""


def or_empty(text: Column) -> Column:
    """NULL becomes the empty string."""
    return F.coalesce(text, F.lit(""))


def leading(text: Column, n: int) -> Column:
    """The first ``n`` characters (code points)."""
    return F.substring(text, 1, n)


def stripped(text: Column) -> Column:
    """Without white space, line ends included, at either side."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def double_quotes(text: Column) -> Column:
    """Each single quote twice, as inside a SQL text literal."""
    return F.replace(text, F.lit("'"), F.lit("''"))


def undouble_quotes(text: Column) -> Column:
    """Each pair of single quotes once."""
    return F.replace(text, F.lit("''"), F.lit("'"))


def fill_template(template: str, values: dict[str, Column]) -> Column:
    """Concatenation of the fixed parts of ``{name}`` text with the columns named in it."""
    pieces = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2:
            pieces.append(values[piece].cast("string"))
        elif piece:
            pieces.append(F.lit(piece))
    return F.concat(*pieces)
